"""R1 (left/inner joins instead of outer joins + final filter) against a
plain pandas statement of the unrewritten plan, on random miniatures with
null ids, null codes, duplicate clients, unknown customers and repeated
visits (SURVEY 4, R1 and SURVEY 5, layer 3)."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from visitwise.plans.unified import unified
from visitwise.schemas import CLIENT_COLUMNS

CLIENT_DDL = ("COD_CIA int, ROWID_TERCERO long, NIT_TERCERO string, ID_TERCERO string, RAZON_SOCIAL string, "
              "COD_SUCURSAL_CLIENTE string, DES_SUCURSAL_CLIENTE string, IND_ESTADO_ACTIVO_CLIENTE int, "
              "COD_DIA_VISITA string, DES_DIA_VISITA string, COD_CO string, COD_FRECUENCIA_VISITA string, "
              "DES_FRECUENCIA_VISITA string, COD_VENDEDOR string, DES_VENDEDOR string, COD_CANAL string, "
              "LONGITUD double, LATITUD double")
CAL_DDL = "FECHAS_VISITA date, COD_DIA_VISITA string, COD_FRECUENCIA_VISITA string"
VIS_DDL = ("ID_TERCERO string, Logintud string, Latitud_Visita string, Inicio_Visita timestamp_ntz, "
           "Finalizacion_Visita timestamp_ntz, FECHAS_VISITA date, FECHAS_VISITA_V date")


def _miniature(seed):
    rnd = random.Random(seed)
    ids = ["A-1", "B-1", "C-1", "D-1", None]
    clients = []
    for i, cid in enumerate(ids):
        row = (2, 100 + i, f"N{i}", cid, f"Razón {i}", "001", "Sucursal", 1,
               rnd.choice(["001", "002", None]), "Día", "001", rnd.choice(["001", "002", None]),
               "F", "V", "Vendedor", "ON", rnd.choice([-74.07, 0.0, None]), 4.71)
        clients.append(row)
        if rnd.random() < 0.3:
            clients.append(row)                           # duplicate client row
    days = [dt.date(2023, 1, d) for d in range(1, 6)]
    cal = [(d, rnd.choice(["001", "002"]), rnd.choice(["001", "002"])) for d in days for _ in range(2)]
    visits = []
    for _ in range(14):
        cid = rnd.choice(ids + ["Z-1"])                   # Z-1: unknown customer
        d = rnd.choice(days)
        start = dt.datetime(d.year, d.month, d.day, rnd.randint(7, 17), rnd.choice([0, 5, 30]))
        end = None if rnd.random() < 0.2 else start + dt.timedelta(minutes=rnd.choice([15, 65, 65, 120]))
        lon = rnd.choice(["-74.071", "-74.08", "0", None])
        visits.append((cid, lon, "4.71", start, end, d, d))
    return clients, cal, visits


def _hav(lon1, lat1, lon2, lat2):
    r = np.radians
    a = (np.sin((r(lat2) - r(lat1)) / 2) ** 2
         + np.cos(r(lat1)) * np.cos(r(lat2)) * np.sin((r(lon2) - r(lon1)) / 2) ** 2)
    return 6371.0 * 2 * np.arctan2(np.sqrt(a), np.sqrt(1 - a)) * 1000


def _pandas_unrewritten(clients, cal, visits):
    """The unrewritten plan, stated in pandas: full, left, full, ranks, filter."""
    cl = pd.DataFrame(clients, columns=CLIENT_COLUMNS)
    ca = pd.DataFrame(cal, columns=["FECHAS_VISITA", "COD_DIA_VISITA", "COD_FRECUENCIA_VISITA"])
    vi = pd.DataFrame(visits, columns=["ID_TERCERO", "Logintud", "Latitud_Visita", "Inicio_Visita",
                                       "Finalizacion_Visita", "FECHAS_VISITA", "FECHAS_VISITA_V"])
    due = pd.merge(cl, ca, how="outer", on=["COD_DIA_VISITA", "COD_FRECUENCIA_VISITA"])
    due = due[CLIENT_COLUMNS + ["FECHAS_VISITA"]]
    facts = pd.merge(vi, cl, how="left", on=["ID_TERCERO"])
    td = facts["Finalizacion_Visita"] - facts["Inicio_Visita"]
    secs = td.dt.total_seconds()
    day_secs = td.dt.seconds
    facts["Time"] = [np.nan if pd.isna(s) else float(f"{int(s) // 3600}{int(s) % 3600 // 60}")
                     for s in day_secs]
    lon = pd.to_numeric(facts["Logintud"], errors="coerce")
    lat = pd.to_numeric(facts["Latitud_Visita"], errors="coerce")
    dist = []
    for a, b, c, d in zip(lon, lat, facts["LONGITUD"], facts["LATITUD"]):
        if any(pd.isna(x) for x in (a, b, c, d)):
            dist.append(np.nan)
        elif 0 in (a, b, c, d):
            dist.append(0.0)
        else:
            dist.append(_hav(a, b, c, d))
    facts["Distancia_Haversine"] = dist
    facts["TimeDifference"] = secs
    res = pd.merge(due, facts.drop(columns=["Logintud", "Latitud_Visita"]), how="outer",
                   on=CLIENT_COLUMNS + ["FECHAS_VISITA"])
    g = res.groupby(["ID_TERCERO", "FECHAS_VISITA"])
    res["Flag_Time"] = g["Time"].rank(method="dense", ascending=False)
    res["Flag_Distance"] = g["Distancia_Haversine"].rank(method="min", ascending=False)
    res = res[res["ROWID_TERCERO"].notnull()]
    return res


def _key(t):
    return tuple("∅" if (x is None or (isinstance(x, float) and np.isnan(x))) else
                 (round(x, 3) if isinstance(x, float) else x) for x in t)


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5, 6])
def test_r1_equals_unrewritten(spark, seed):
    clients, cal, visits = _miniature(seed)
    got = unified(spark.createDataFrame(clients, CLIENT_DDL), spark.createDataFrame(cal, CAL_DDL),
                  spark.createDataFrame(visits, VIS_DDL)).toPandas()
    exp = _pandas_unrewritten(clients, cal, visits)
    cols = ["ROWID_TERCERO", "ID_TERCERO", "FECHAS_VISITA", "Inicio_Visita", "Time",
            "Distancia_Haversine", "Flag_Time", "Flag_Distance"]
    g = sorted((_key(r) for r in got[cols].astype(object).itertuples(index=False)), key=repr)
    e = sorted((_key(r) for r in exp[cols].astype(object).itertuples(index=False)), key=repr)
    assert len(g) == len(e)
    assert g == e
