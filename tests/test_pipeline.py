import datetime as dt
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from vialis.plans import bronze, gold, silver, transit
from vialis.sources import files, tables


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture
def inputs(tmp_path):
    """Small source files of every kind."""
    square = [[-75.6, 6.2], [-75.5, 6.2], [-75.5, 6.3], [-75.6, 6.3], [-75.6, 6.2]]
    collection = {"type": "FeatureCollection", "features": [{
        "type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square]},
        "properties": {"osm_id": 5, "nombre": "Comuna 1", "tipo": "comuna", "admin_level": "8", "nombre_alt": "", "wikipedia": ""}}]}
    incident = 'NRO_RADICADO,AÑO,FECHA_ACCIDENTES,CLASE_ACCIDENTE,GRAVEDAD_ACCIDENTE,DISEÑO,BARRIO,COMUNA,DIRECCION,LOCATION\n'
    rows = ['1,2020,2020-05-01T10:00:00.000Z,Choque,Con muertos,Tramo,B,Texto,"CL 1\nint 2","[-75.55, 6.25]"',
            '1,2020,2020-05-01T10:00:00.000Z,Choque,Con muertos,Tramo,B,Texto,"CL 1\nint 2","[-75.55, 6.25]"',
            '2,2020,2020-05-02T11:00:00.000Z,Choque,Con heridos,Tramo,B,Texto,CL 1,"[6.25, -75.55]"',
            '3,2021,2021-05-02T11:00:00.000Z,Choque,Solo daños,Tramo,B,Texto,CL 9,"[-75.9, 6.25]"',
            '4,2021,2021-05-02T11:00:00.000Z,Choque,Solo daños,Tramo,B,Texto,CL 9,"[0, 0]"']
    hours = "".join(f"2020-05-{d:02d},{line},{h},{100 * d + h}\n" for d in range(1, 13) for line in ("A", " B") for h in (7, 8))
    trips = ("id_viaje,id_usuario,estacion_origen,estacion_destino,ts_inicio,ts_fin,duracion_min\n"
             "v1,u1,E1,E2,2020-05-01T07:00:00Z,2020-05-01T07:09:00Z,9\nv1,u1,E1,E2,2020-05-01T07:00:00Z,2020-05-01T07:09:00Z,9\n"
             "v2,,E1,E2,2020-05-02T07:00:00Z,2020-05-02T07:40:00Z,40\nv3,u2,E1,E2,2020-05-02T07:00:00Z,2020-05-02T07:40:00Z,400\n")
    readings = "timestamp,estacion_id,variable,valor\n" + "".join(
        f"2020-05-{d:02d} {h:02d}:00:00,S1,pm25,{10 + d}\n2020-05-{d:02d} {h:02d}:00:00,S1,pm25,-999\nayer,S1,pm25,1\n"
        for d in range(1, 13) for h in (1, 2))
    return {
        "incidents": write(tmp_path / "in/incidentes.csv", incident + "\n".join(rows) + "\n"),
        "ridership": write(tmp_path / "in/afluencia_2020.csv", "fecha,linea,hora,pasajeros\n" + hours + "2020-05-01,A,25,7\n2020-05-01,A,9,0\n"),
        "trips": write(tmp_path / "in/prestamos.csv", trips),
        "pm25": write(tmp_path / "in/pm25.csv", readings),
        "pm10": write(tmp_path / "in/pm10.csv", "timestamp,estacion_id,variable,valor\n2020-05-01 01:00:00,S1,pm10,33\n"),
        "stations": write(tmp_path / "in/estaciones.tab", 'codigo\tnombre_completo\tnombre_corto\tlatitud\tlongitud\tmunicipio\n1\t"Uno"\tS1\t6.2\t-75.5\tBello\n2\tDos\t\t6.2\t-75.5\tBello\n'),
        "polygons": write(tmp_path / "in/limites.geojson", json.dumps(collection, indent=1)),
        "manual": write(tmp_path / "in/aforos.csv", "COORDENADAX,COORDENADAY,Vía Principal,FECHA_HORA,AUTOS,BUSES,CAMIONES,MOTOS\n-75.55,6.25,Calle 33,2020-05-01 10:00,5,x,,2\n-75.55,1,Calle 33,2020-05-01 10:00,5,1,1,2\n"),
        "cameras": write(tmp_path / "in/camaras.csv", "LOCATION,CORREDOR,FECHAHORA,INTENSIDAD,VELOCIDAD,OCUPACION,DISPOSITIVO\n\"{'lon': '-75.56','lat': '6.26'}\",Carrera 70,2020-05-02T10:00:00,12,30,5,D1\n\"{'lon': '-75.56','lat': '6.26'}\",Carrera 80,2020-05-02T11:00:00,,30,5,D1\n"),
        "legacy": write(tmp_path / "in/legado.csv", '7,01/02/2016 10:00:00,Choque,Solo daños,Centro,"CL 1, piso 2",-75.5|6.2\n7,2016-02-01T10:00:00.000Z,Choque,Solo daños,Centro,La Candelaria,CL 1,"[-75.5, 6.2]"\n'),
        "empty": write(tmp_path / "in/vacio.csv", ""),
    }


KEY = "clave-de-prueba"


def load(spark, inputs, layers):
    return {
        "incidents": bronze.load_incidents(spark, [inputs["incidents"], inputs["empty"]], layers),
        "ridership": bronze.load_ridership(spark, [inputs["ridership"]], layers),
        "trips": bronze.load_trips(spark, [inputs["trips"]], KEY, layers),
        "air": bronze.load_air(spark, [inputs["pm25"], inputs["pm10"]], [inputs["stations"]], layers),
        "polygons": bronze.load_polygons(spark, [inputs["polygons"]], layers),
        "counts": bronze.load_counts(spark, [inputs["manual"]], [inputs["cameras"]], layers=layers),
        "legacy": bronze.load_legacy(spark, [inputs["legacy"]], layers),
    }


def test_whole_pipeline(spark, inputs, layers, tmp_path):
    assert load(spark, inputs, layers) == {
        "incidents": 5, "ridership": 48, "trips": 4, "air": 24, "polygons": 1, "counts": 4, "legacy": 1}
    # The same files again add nothing.
    assert set(load(spark, inputs, layers).values()) == {0}
    raw = spark.table(layers.raw("incidentes"))
    assert {"timestamp_ingesta", "nombre_archivo", "fuente_id", "fecha_ingesta"} <= set(raw.columns)
    assert [r[0] for r in raw.select("nombre_archivo").distinct().collect()] == ["incidentes.csv"]
    trips = {r["id_viaje"]: r["usuario_pseudo"] for r in spark.table(layers.raw("viajes")).collect()}
    assert trips["v1"] == hmac.new(KEY.encode(), b"u1", hashlib.sha256).hexdigest() and trips["v2"] is None

    silver.build(spark, layers)
    incidents = {r["incidente_id"]: r for r in spark.table(layers.clean("incidentes")).collect()}
    assert set(incidents) == {"1", "2", "3"}
    assert [incidents[i]["comuna"] for i in "123"] == ["Comuna 1", "Comuna 1", "Texto"]
    assert (incidents["2"]["longitud"], incidents["2"]["latitud"]) == (-75.55, 6.25)
    assert "\n" in incidents["1"]["direccion"] and incidents["1"]["mes_accidente"] == 5
    air = spark.table(layers.clean("aire"))
    assert air.count() == 24 and air.filter("pm25 < 0").isEmpty()
    assert air.first()["zona"] == "valle_aburra_norte"
    ridership = spark.table(layers.clean("afluencia_horaria"))
    assert ridership.count() == 48 and {r["linea"] for r in ridership.collect()} == {"A", "B"}
    day = ridership.filter("fecha = '2020-05-03' and linea = 'A' and hora = 7").first()
    assert (day["pm25_promedio_red"], day["franja_horaria"], day["es_finde"], day["dia_semana"]) == (13.0, "punta_am", 1, 1)
    assert {(r["id_viaje"], r["categoria_duracion"]) for r in spark.table(layers.clean("viajes")).collect()} == {("v1", "corta"), ("v2", "larga")}
    counts = {(r["tipo_aforo"], r["corredor"], r["vehiculos"], r["comuna"]) for r in spark.table(layers.clean("aforos_corredor")).collect()}
    assert counts == {("manual", "Calle 33", 7, "Comuna 1"), ("camara", "Carrera 70", 12, "Comuna 1")}

    gold.build(spark, layers)
    monthly = {r["linea"]: r for r in spark.table(layers.derived("afluencia_vs_pm25")).collect()}
    assert monthly["A"]["dias_observados"] == 12 and monthly["A"]["corr_pm25_pasajeros"] == pytest.approx(1.0)
    assert monthly["A"]["corr_precip_pasajeros"] is None
    severity = {(r["anio"], r["comuna"]): r for r in spark.table(layers.derived("accidentalidad_por_comuna")).collect()}
    assert severity[2020, "Comuna 1"]["indice_severidad"] == pytest.approx(6.0)
    demand = spark.table(layers.derived("demanda_bici_vs_clima")).orderBy("fecha").collect()
    assert [(r["bin_temperatura"], r["bin_pm25"], r["llovio"], r["viajes"], r["viajes_relativos_pct"]) for r in demand] == [
        ("sin_dato", "0-15", 0, 1, 0.0), ("sin_dato", "0-15", 0, 1, 0.0)]
    risk = spark.table(layers.derived("corredores_riesgo_compuesto")).collect()
    assert [(r["comuna"], r["vehiculos_total"], r["corredores_distintos"], r["score_riesgo"]) for r in risk] == [("Comuna 1", 19, 2, 2)]
    assert spark.table(layers.derived("percentiles_linea")).count() == 2

    corridors = gold.risk_corridors(spark.table(layers.clean("incidentes")))
    assert {"Cl 1", "Cl 9", "Calle 33"} <= {r["corredor"] for r in corridors.collect()}
    percentiles = spark.table(layers.derived("percentiles_linea"))
    gold.export_references(percentiles, corridors, str(tmp_path / "ref"))
    again = tables.load_reference(spark, layers.derived("nada"), str(tmp_path / "ref/percentiles_linea"))
    assert sorted(map(tuple, again.select(*percentiles.columns).collect())) == sorted(map(tuple, percentiles.collect()))
    assert tables.load_risk_corridors(spark, str(tmp_path / "ref/corredores_riesgo")).count() == corridors.count()
    assert tables.load_risk_corridors(spark, str(tmp_path / "ref/nada")).count() == 8


def test_network_tables(spark, layers):
    stations = transit.stations(spark)
    gold.build_network(spark, stations, transit.links(spark), stations, layers)
    ranks = spark.table(layers.derived("red_pagerank"))
    assert ranks.count() == 34 and ranks.agg(F.sum("pagerank")).first()[0] == pytest.approx(1.0)
    assert sorted(r["ranking"] for r in ranks.collect()) == list(range(1, 35))
    assert spark.table(layers.derived("red_rutas_optimas")).count() == 1122


def test_missing_inputs(spark, inputs, tmp_path, layers):
    with pytest.raises(FileNotFoundError):
        bronze.load_ridership(spark, [inputs["empty"], str(tmp_path / "no*.csv")], layers)


def test_loads_lose_and_double_nothing(spark, layers, tmp_path):
    """Equal base names, a superset, a grown file, a load that was cut off."""
    table = layers.raw("lecturas")
    read = lambda found: spark.read.schema("i int, w string").csv(found)
    load = lambda *names: tables.append_files(spark, [str(tmp_path / n) for n in names], table, "s", read)
    held = lambda: sorted(r["i"] for r in spark.table(table).collect())
    write(tmp_path / "2021/data.csv", "1,a\n")
    write(tmp_path / "2022/data.csv", "2,b\n3,c\n")
    assert load("2021/data.csv") == 1 and load("2022/data.csv") == 2
    assert load("2021/data.csv", "2022/data.csv") == 0 and held() == [1, 2, 3]
    write(tmp_path / "2023/data.csv", "9,z\n")
    assert load("2021/data.csv", "2022/data.csv", "2023/data.csv") == 1
    write(tmp_path / "2022/data.csv", "2,b\n3,c\n4,d\n")
    assert load("2021/data.csv", "2022/data.csv") == 3 and held() == [1, 2, 3, 4, 9]
    # The rows were written, the load was never committed: the next load drops its partition.
    write(tmp_path / "2024/data.csv", "7,x\n")
    tables._write(tables.audited(read([str(tmp_path / "2024/data.csv")]), "s"), table, "cutoff", "fecha_ingesta")
    assert sorted(r["i"] for r in tables.held(spark, table).collect()) == [1, 2, 3, 4, 9]
    assert load("2024/data.csv") == 1 and held() == [1, 2, 3, 4, 7, 9]
    assert tables.append_raw(spark.createDataFrame([(5, "e")], "i int, w string"), table, "s", "frame") == 1
    assert tables.append_raw(spark.createDataFrame([(5, "e")], "i int, w string"), table, "s", "frame") == 0


@pytest.mark.parametrize("step", ["_write", "_commit", "_drop_loads"])
@pytest.mark.parametrize("after", [False, True])
def test_a_reload_cut_off_anywhere(spark, layers, tmp_path, monkeypatch, step, after):
    """One file of a load of two grows, the other leaves; the load breaks before or after each step and is tried again."""
    table = layers.raw("lecturas")
    read = lambda found: spark.read.schema("i int, w string").csv(found)
    load = lambda *names: tables.append_files(spark, [str(tmp_path / n) for n in names], table, "s", read)
    held = lambda df: sorted((r["i"], r["nombre_archivo"]) for r in df.collect())
    write(tmp_path / "a.csv", "1,a\n2,a\n")
    write(tmp_path / "b.csv", "3,b\n")
    write(tmp_path / "c.csv", "9,c\n")
    load("a.csv", "b.csv")
    load("c.csv")
    write(tmp_path / "b.csv", "3,b\n4,b\n")
    (tmp_path / "a.csv").unlink()
    real, calls = getattr(tables, step), []

    def broken(*args, **kwargs):
        calls.append(step)
        # The first call of _drop_loads clears what earlier loads left; the second one ends this load.
        if step == "_drop_loads" and len(calls) == 1:
            return real(*args, **kwargs)
        if after:
            real(*args, **kwargs)
        raise RuntimeError("cut off")

    monkeypatch.setattr(tables, step, broken)
    with pytest.raises(RuntimeError):
        load("b.csv")
    monkeypatch.setattr(tables, step, real)
    before, now = [(1, "a.csv"), (2, "a.csv"), (3, "b.csv"), (9, "c.csv")], [(1, "a.csv"), (2, "a.csv"), (3, "b.csv"), (4, "b.csv"), (9, "c.csv")]
    committed = step == "_drop_loads" or step == "_commit" and after
    assert held(tables.held(spark, table)) == (now if committed else before)
    assert load("b.csv") == (0 if committed else 2)
    assert held(spark.table(table)) == now and held(tables.held(spark, table)) == now


def test_rows_of_several_files_and_one_that_left(spark, layers, tmp_path):
    head = "timestamp,estacion_id,variable,valor\n"
    a = write(tmp_path / "a.csv", head + "2020-05-01 01:00:00,S1,pm25,10\n2020-05-01 02:00:00,S1,pm25,11\n")
    b = write(tmp_path / "b.csv", head + "2020-05-01 01:00:00,S1,pm10,5\n2020-05-01 03:00:00,S1,pm25,7\n")
    assert bronze.load_air(spark, [a, b], layers=layers) == 3
    write(tmp_path / "b.csv", head + "2020-05-01 01:00:00,S1,pm10,6\n2020-05-01 04:00:00,S1,pm25,8\n")
    (tmp_path / "a.csv").unlink()
    assert bronze.load_air(spark, [b], layers=layers) == 2
    rows = silver.clean_air(tables.held(spark, layers.raw("aire"))).orderBy("timestamp").collect()
    assert [(r["hora"], r["pm25"], r["pm10"]) for r in rows] == [(1, 10.0, 6.0), (2, 11.0, None), (4, 8.0, None)]


def test_readings_of_one_hour_in_two_loads(spark, layers, tmp_path):
    head = "timestamp,estacion_id,variable,valor\n"
    a = write(tmp_path / "a.csv", head + "2020-05-01 01:00:00,S1,pm25,10\n")
    b = write(tmp_path / "b.csv", head + "2020-05-01 01:00:00,S1,pm10,5\n")
    assert bronze.load_air(spark, [a], layers=layers) == bronze.load_air(spark, [b], layers=layers) == 1
    rows = silver.clean_air(spark.table(layers.raw("aire"))).collect()
    assert [(r["pm25"], r["pm10"]) for r in rows] == [(10.0, 5.0)]


def test_air_of_a_superset_is_not_doubled(spark, layers, tmp_path):
    head = "timestamp,estacion_id,variable,valor\n"
    a = write(tmp_path / "a.csv", head + "2020-05-01 01:00:00,S1,pm25,10\n")
    b = write(tmp_path / "b.csv", head + "2020-05-01 02:00:00,S1,pm25,20\n")
    assert bronze.load_air(spark, [a], layers=layers) == 1
    assert bronze.load_air(spark, [a, b], layers=layers) == 1
    assert sorted((r["pm25"], r["nombre_archivo"]) for r in spark.table(layers.raw("aire")).collect()) == [(10.0, "a.csv"), (20.0, "b.csv")]


def test_monthly_station_files(spark, tmp_path):
    write(tmp_path / "m/pm25_2020_01.tab", "Fecha_Hora\tS.1\tS 2\n2020-01-01 00:00:00\t1.5\t\n2020-01-01 01:00:00\t \t2\n")
    write(tmp_path / "m/pm25_2021_01.tab", "Fecha_Hora\tS3\n2021-01-01 00:00:00\tn/d\n2021-01-01 01:00:00\t4\n")
    write(tmp_path / "m/pm25_2019_12.tab", "Fecha_Hora\tS3\n2019-12-01 00:00:00\t9\n")
    found = files.read_station_months(spark, [str(tmp_path / "m/*.tab")], "pm25", 2020, 2021)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("2020-01-01 00:00:00", "S.1", "pm25", 1.5), ("2020-01-01 01:00:00", "S 2", "pm25", 2.0), ("2021-01-01 01:00:00", "S3", "pm25", 4.0)]


def test_hundreds_of_station_files_in_one_scan(spark, tmp_path):
    want = []
    for i in range(500):
        names = [f"S{i % 7}", "", '"S 9"'] if i % 2 else ["X", f"S{i % 5}"]
        year = 2010 + i % 12
        place = tmp_path / f"m/{i}/pm25_{year}_0{1 + i % 9}.tab" if i % 3 else tmp_path / f"m/pm25_{year}_0{1 + i % 9}/part-{i}.csv"
        write(place, "Fecha\t" + "\t".join(names) + f"\n2020-01-01 00:00:00\t{i}\t \t1.5\n\n\t9\t9\n2020-01-02 00:00:00\tx\t{i}.5\n")
        if 2012 <= year <= 2015:
            clean = [n.strip('"') for n in names]
            cells = [(0, i), (2, 1.5)] + [(1, i + 0.5)]
            want += [(clean[c], float(x)) for c, x in cells if c < len(clean) and clean[c]]
    found = files.read_station_months(spark, [str(tmp_path / "m/*/*")], "pm25", 2012, 2015)
    assert sorted((r["estacion_id"], r["valor"]) for r in found.collect()) == sorted(want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and " text" in plan


def test_audit_columns_name_each_file(spark, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"x/{name}.csv", f"fecha,linea,hora,pasajeros\n2020-01-01,{name},1,2\n")
    rows = tables.audited(files.read_ridership(spark, str(tmp_path / "x/*.csv")), "f").collect()
    assert {(r["linea"], r["nombre_archivo"], r["fuente_id"]) for r in rows} == {("a", "a.csv", "f"), ("b", "b.csv", "f")}
    assert all(isinstance(r["fecha_ingesta"], dt.date) for r in rows)


def test_keys_of_small_files_are_counted_in_as_many_tasks_as_rows_ask_for(spark):
    from vialis.questions import stored
    from vialis.session import by_hash
    from vialis.sources import tables

    assert by_hash(spark.range(10), "id", rows=5_000_001).rdd.getNumPartitions() == 11
    plan = stored.bronze_same_names(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [o_orderkey" in plan
    before = spark.conf.get(tables.OPEN_FILES, None)
    with tables.unsorted_writes(spark):
        assert spark.conf.get(tables.OPEN_FILES) == "4"
    assert spark.conf.get(tables.OPEN_FILES, None) == before
