"""Q01 client extract and Q02 visit extract on small literal fixtures,
checked against rows worked out by hand from the fixtures."""

from visitwise.plans.extract import client_extract

T = {
    "t200": ("F200_ID_CIA int, F200_ROWID long, F200_NIT string, F200_RAZON_SOCIAL string",
             [(2, 10, "900", "Tienda Ñ"), (2, 11, "901", "Bodega"), (3, 12, "902", "Otra cia")]),
    "t201": ("F201_ID_CIA int, F201_ROWID_TERCERO long, F201_ID_SUCURSAL string, "
             "F201_DESCRIPCION_SUCURSAL string, F201_IND_ESTADO_ACTIVO int, F201_ID_CO_FACTURA string, "
             "F201_ROWID_MOVTO_ENTIDAD long",
             [(2, 10, "001", "Principal", 1, "01", 100), (2, 11, "001", "Norte", 0, "01", 101),
              (2, 11, "002", "Sur", 1, "02", 102), (3, 12, "001", "X", 1, "01", 103)]),
    "t750": ("F750_ROWID long", [(100,), (101,), (102,), (103,)]),
    "t752": ("F752_ROWID long, F752_ROWID_MOVTO_ENTIDAD long, F752_ROWID_ENTIDAD long",
             [(1000, 100, 181), (1001, 101, 201), (1002, 102, 181), (1003, 103, 181), (1004, 100, 999)]),
    "t742": ("F742_ROWID long", [(181,), (201,), (999,)]),
    "t753": ("F753_ROWID_ENTIDAD long, F753_ROWID_MOVTO_ENTIDAD_FILA long, F753_ROWID_MOVTO_ENTIDAD long, "
             "F753_ROWID_ENTIDAD_ATRIBUTO long, F753_DATO_TEXTO string",
             [(181, 1000, 100, 881, "-74,07"), (181, 1000, 100, 882, "4,71"),
              (201, 1001, 101, 901, "-74,08"), (201, 1001, 101, 902, "4,72"),
              (181, 1002, 102, 881, "-74,09"), (181, 1002, 102, 882, "4,73"),
              (181, 1002, 102, 0, "ruido"), (181, 1003, 103, 881, "-75"), (181, 1003, 103, 882, "6")]),
    "t743": ("F743_ROWID long, F743_ROWID_ENTIDAD long",
             [(881, 181), (882, 181), (901, 201), (902, 201), (950, 181)]),
    "t207": ("F207_ID_CIA int, F207_ROWID_TERCERO long, F207_ID_SUCURSAL string, "
             "F207_ID_PLAN_CRITERIOS string, F207_ID_CRITERIO_MAYOR string",
             [(2, 10, "001", "001", "002"), (2, 10, "001", "002", "001"), (2, 10, "001", "CCD", "ON"),
              (2, 10, "001", "VEN", "V7"), (2, 11, "002", "001", "003")]),
    "t206": ("F206_ID_CIA int, F206_ID_PLAN string, F206_ID string, F206_DESCRIPCION string",
             [(2, "001", "002", "Lunes"), (2, "001", "003", "Martes"), (2, "002", "001", "Semanal"),
              (2, "CCD", "ON", "ON"), (2, "VEN", "V7", "Vendedor Siete")]),
}

T["t204"] = ("F204_ID_CIA int, F204_ID string", [(2, p) for p in ("001", "002", "CCD", "VEN")])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _frames(spark, **changed):
    return {k: spark.createDataFrame(rows, ddl) for k, (ddl, rows) in (T | changed).items()}


def _client(nit, branch, name, active, co, criteria, lon, lat, third):
    day, freq, seller, channel = criteria
    return (2, third, nit, f"{nit}-{branch}", {"10": "Tienda Ñ", "11": "Bodega"}[str(third)], branch, name, active,
            *day, co, *freq, *seller, channel, lon, lat)


NONE = ((None, None), (None, None), (None, None), None)
FULL = (("002", "Lunes"), ("001", "Semanal"), ("V7", "Vendedor Siete"), "ON")
# branch 002 of third party 11 has a value of attribute 0: it meets the two
# attributes of its entity that are no longitude (882, 950), and the two that
# are no latitude (881, 950)
NOISY = [_client("901", "002", "Sur", 1, "02", (("003", "Martes"), *NONE[1:]), lon, lat, 11)
         for lon in ("-74,09", "ruido", "ruido") for lat in ("4,73", "ruido", "ruido")]
PLAIN = _client("901", "001", "Norte", 0, "01", NONE, "-74,08", "4,72", 11)
FIRST = _client("900", "001", "Principal", 1, "01", FULL, "-74,07", "4,71", 10)


def test_client_extract_rows(spark):
    assert _rows(client_extract(**_frames(spark))) == sorted([FIRST, PLAIN, *NOISY], key=repr)


def test_two_criteria_of_one_plan_keep_their_descriptions(spark):
    ddl, rows = T["t207"]
    got = _rows(client_extract(**_frames(spark, t207=(ddl, [*rows, (2, 10, "001", "001", "003"), (2, 10, "001", "CCD", "??")]))))
    want = [_client("900", "001", "Principal", 1, "01", (day, FULL[1], FULL[2], channel), "-74,07", "4,71", 10)
            for day in (("002", "Lunes"), ("003", "Martes")) for channel in ("ON", None)]
    assert got == sorted([*want, PLAIN, *NOISY], key=repr)


def test_a_doubled_plan_row_doubles_its_clients(spark):
    ddl, rows = T["t204"]
    got = _rows(client_extract(**_frames(spark, t204=(ddl, [*rows, (2, "VEN"), (3, "001")]))))
    assert got == sorted([FIRST, FIRST, PLAIN, *NOISY], key=repr)
    # a plan that the table does not list takes nothing away
    got = _rows(client_extract(**_frames(spark, t204=(ddl, rows[:1]))))
    assert got == sorted([FIRST, PLAIN, *NOISY], key=repr)


def test_visit_extract_rows(spark):
    import datetime as dt
    from visitwise.plans.extract import visit_extract
    t = dt.datetime(2023, 5, 1, 8)
    visits = spark.createDataFrame(
        [("-74,1", "4,6", t, t, 1, 2, 7), ("0", "4,6", t, t, 1, 2, 7), ("-74,1", None, t, t, 1, 2, 7),
         ("-74,1", "4,6", t, t, 9, 2, 7), ("-74,2", "4,7", t, None, 2, 1, 8)],
        "longitud string, latitud string, fecha_inicio timestamp_ntz, fecha_final timestamp_ntz, tercero_id int, vendedor_id int, sucursal_id int")
    people = spark.createDataFrame([(1, "Ana", "Paz", "Gil", "100"), (2, "Luis", "Mora", None, "200")],
                                   "usuario_id int, nombre_completo string, primer_apellido string, segundo_apellido string, numero_identificacion string")
    branches = spark.createDataFrame([(7, "001"), (8, "002")], "sucursal_id int, numero_sucursal string")
    assert _rows(visit_extract(visits, people, branches)) == sorted([
        ("-74,1", "4,6", t, t, "Ana Paz Gil", "100-001", "100", "001", "200", None),
        ("-74,2", "4,7", t, None, None, "200-002", "200", "002", "100", "Paz Ana Gil")], key=repr)


def test_extract_from_reader(spark):
    from visitwise.plans.extract import CLIENT_SOURCE_TABLES, extract_from
    dfs = _frames(spark)
    by_name = {CLIENT_SOURCE_TABLES[k]: v for k, v in dfs.items()}
    got = extract_from(lambda t: by_name[t], "clients")
    assert got.count() == client_extract(**dfs).count()


def test_calendar_csv_loader(spark, tmp_path):
    from visitwise.plans.daily import load_calendar
    p = tmp_path / "cal.csv"
    header = "FECHA,COD_DIA VISITA,DIA VISITA,COD SEMANAL,SEMANAL,COD QUINCENAL,QUINCENAL ,COD MENSUAL,MENSUAL"
    rows = ["1/1/2023,001,Domingo,001,Semanal,002,Quincena 1 y 3,004,Mensual Semana 1",
            "31/12/2023,001,Domingo,001,Semanal,003,Quincena 2 y 4,007,Mensual Semana 4"]
    p.write_bytes(("﻿" + "\r\n".join([header] + rows) + "\r\n").encode("utf-8"))
    cal = load_calendar(spark, str(p))
    import datetime as dt
    got = sorted((r.FECHA, r.COD_DIA_VISITA, r.COD_QUINCENAL, r.COD_MENSUAL) for r in cal.collect())
    assert got == [(dt.date(2023, 1, 1), "001", "002", "004"), (dt.date(2023, 12, 31), "001", "003", "007")]
