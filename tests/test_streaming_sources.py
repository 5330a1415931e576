"""Streaming visit facts and the file sources."""

import os
import tempfile

from visitwise.plans import driver as D
from visitwise.plans import registry as R
from visitwise.plans.prepare import prepare_visits
from visitwise.plans.route import visit_facts
from visitwise.schemas import VISITS, conform
from visitwise.sources.files import read_csv_latin1, read_csv_lossy, read_csv_text
from visitwise.streaming import start_visit_facts

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="vw-stream-")
    landing, out = os.path.join(base, "landing"), os.path.join(base, "facts")
    raw = conform(D.visits_raw(spark, SF), VISITS)
    # two arrivals: the stream must pick up both, each once
    raw.where("Nit < '7'").write.parquet(os.path.join(landing, "a"))
    clients = R.clients(spark, SF)
    q = start_visit_facts(spark, os.path.join(landing, "*"), clients, 2024, out,
                          os.path.join(base, "ckpt"))
    q.awaitTermination()
    raw.where("Nit >= '7'").write.parquet(os.path.join(landing, "b"))
    q = start_visit_facts(spark, os.path.join(landing, "*"), clients, 2024, out,
                          os.path.join(base, "ckpt"))
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = visit_facts(prepare_visits(raw, 2024), clients)
    assert streamed.count() == batch.count()
    cols = ["ID_TERCERO", "Inicio_Visita", "TimeDifference", "Rango_Visita"]
    assert sorted(streamed.select(cols).collect()) == sorted(batch.select(cols).collect())


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_csv_text_header_bom_crlf(spark):
    d = tempfile.mkdtemp(prefix="vw-csv-")
    p = _write(os.path.join(d, "cal.csv"),
               "﻿FECHA,COD_DIA VISITA,QUINCENAL \r\n1/1/2023,001,Quincena 1 y 3\r\n".encode("utf-8"))
    df = read_csv_text(spark, p)
    assert df.columns == ["FECHA", "COD_DIA VISITA", "QUINCENAL"]
    assert [tuple(r) for r in df.collect()] == [("1/1/2023", "001", "Quincena 1 y 3")]


def test_csv_latin1_and_lossy(spark):
    d = tempfile.mkdtemp(prefix="vw-csv-")
    p = _write(os.path.join(d, "l1.csv"), "a;b\r\nPe\xf1a;007\r\n".encode("latin-1"))
    assert [tuple(r) for r in read_csv_latin1(spark, p, sep=";").collect()] == [("Peña", "007")]
    p2 = _write(os.path.join(d, "bad.csv"), b"a,b\nx\xffy,1\n")
    assert [tuple(r) for r in read_csv_lossy(spark, p2).collect()] == [("xy", "1")]


def test_csv_inferred_and_calendar_load(spark):
    from visitwise.plans.extract import calendar_load
    from visitwise.sources.files import read_csv_inferred
    d = tempfile.mkdtemp(prefix="vw-csv-")
    p = _write(os.path.join(d, "c.csv"),
               "﻿FECHA,COD_DIA VISITA,QUINCENAL \r\n1/1/2023,001,Quincena 1 y 3\r\n".encode("utf-8"))
    inf = read_csv_inferred(spark, p)
    assert dict(inf.dtypes)["COD_DIA VISITA"] == "int"      # codes lose their zeros
    out = calendar_load(spark, p, os.path.join(d, "landed"))
    assert out.columns == ["FECHA", "COD_DIA_VISITA", "QUINCENAL"]
    assert [tuple(r) for r in out.collect()] == [("1/1/2023", "001", "Quincena 1 y 3")]


def test_landed_sheet_csv_and_parquet(spark):
    from visitwise.sources.files import read_landed_sheet
    d = tempfile.mkdtemp(prefix="vw-sheet-")
    p = _write(os.path.join(d, "dist.csv"), b"Cod_Cliente,Inicio_Visita\n001,01/05/2023 08:00\n")
    csv_df = read_landed_sheet(spark, p)
    assert [tuple(r) for r in csv_df.collect()] == [("001", "01/05/2023 08:00")]
    pq = os.path.join(d, "dist.parquet")
    csv_df.write.parquet(pq)
    assert read_landed_sheet(spark, pq).count() == 1
