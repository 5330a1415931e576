"""Extracts (Q01-Q03) run on Spark over copies of the source tables.

The reference sends two SQL texts to a relational server; here the same
joins are DataFrame code, so they run on parquet copies of the tables or
on JDBC sources (``sources.jdbc``) alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitwise.functions.codes import concat_strict

# Numeric prefix of a text, the rule the source database applies when text
# is compared with a number ('-74,12' -> -74, no digits -> 0).
PREFIX_RE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"


def text_as_number(c) -> "F.Column":
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.regexp_extract(c, PREFIX_RE, 0).try_cast("double"), F.lit(0.0))


def nonzero_coordinates(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """``lon != 0 AND lat != 0`` on text columns (null rows drop out)."""
    return df.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()
                    & (text_as_number(lon) != 0) & (text_as_number(lat) != 0))


def visit_extract(visita: DataFrame, usuario: DataFrame, sucursal: DataFrame) -> DataFrame:
    """Q02: one row per visit with non-zero coordinates whose customer,
    salesperson and branch are known; 10 renamed columns (P01).

    Customer and salesperson are persons of one table (J24): the names each
    role shows are put together once, then the two roles are looked up.
    """
    person = usuario.select(
        "usuario_id", F.col("numero_identificacion").alias("number"),
        concat_strict("nombre_completo", "primer_apellido", "segundo_apellido", sep=" ").alias("as_customer"),
        concat_strict("primer_apellido", "nombre_completo", "segundo_apellido", sep=" ").alias("as_seller"))
    customer = person.select(F.col("usuario_id").alias("tercero_id"), F.col("number").alias("Nit"),
                             F.col("as_customer").alias("Razon_Social_Cliente"))
    seller = person.select(F.col("usuario_id").alias("vendedor_id"), F.col("number").alias("Codigo_Vendedor"),
                           F.col("as_seller").alias("Des_vendedor"))
    branch = sucursal.select("sucursal_id", F.col("numero_sucursal").alias("Codigo_Sucursal"))
    found = (nonzero_coordinates(visita, "longitud", "latitud")
             .join(branch, "sucursal_id").join(customer, "tercero_id").join(seller, "vendedor_id"))
    return found.select(
        F.col("longitud").alias("Logintud"), F.col("latitud").alias("Latitud"),
        F.col("fecha_inicio").alias("Inicio_Visita"), F.col("fecha_final").alias("Finalizacion_Visita"),
        "Razon_Social_Cliente", concat_strict("Nit", "Codigo_Sucursal", sep="-").alias("ID_TERCERO"),
        "Nit", "Codigo_Sucursal", "Codigo_Vendedor", "Des_vendedor")


# Fixed values of the client extract.
COMPANY_ID = 2
ENTITY_IDS = (181, 201)
CRITERIA_PLANS = {"001": ("COD_DIA_VISITA", "DES_DIA_VISITA"),
                  "002": ("COD_FRECUENCIA_VISITA", "DES_FRECUENCIA_VISITA"),
                  "VEN": ("COD_VENDEDOR", "DES_VENDEDOR"),
                  "CCD": (None, "COD_CANAL")}


def _coordinate_rows(t752: DataFrame, t742: DataFrame, t753: DataFrame, t743: DataFrame,
                     wanted: tuple[int, int], name: str) -> DataFrame:
    """J22 + J23: per movement row (T752), the text value of the attribute
    whose id is one of ``wanted`` (CASE key: other attribute ids become 0)."""
    from visitwise.operators.eav import case_key_join
    cols = t753.select(F.col("F753_ROWID_ENTIDAD").alias("_ent"),
                       F.col("F753_ROWID_MOVTO_ENTIDAD_FILA").alias("_fila"),
                       F.col("F753_ROWID_MOVTO_ENTIDAD").alias("_mov"),
                       F.col("F753_ROWID_ENTIDAD_ATRIBUTO").alias("attr_id"),
                       F.col("F753_DATO_TEXTO").alias(name))
    attrs = t743.select(F.col("F743_ROWID").alias("attr_rowid"),
                        F.col("F743_ROWID_ENTIDAD").alias("_aent"))
    j = case_key_join(cols, attrs, wanted, also=[("_ent", "_aent")])
    return j.select("_ent", "_fila", "_mov", name)


def criteria_lists(criteria: DataFrame, key: list[str]) -> DataFrame:
    """Per ``key`` one array for each plan with its (code, descr) pairs,
    from rows (key, plan, code, descr). Pairs stay together and repeats stay."""
    return criteria.groupBy(*key).agg(*[
        F.collect_list(F.when(F.col("plan") == plan, F.struct("code", "descr"))).alias(f"_{plan}")
        for plan in CRITERIA_PLANS])


def with_criteria(clients: DataFrame, lists: DataFrame, key: list[str]) -> DataFrame:
    """Every combination of a client's criteria, one per plan, as the columns of
    ``CRITERIA_PLANS``; a plan without criteria gives nulls (left joins)."""
    out = clients.join(lists, key, "left")
    for plan, (code, descr) in CRITERIA_PLANS.items():
        out = out.withColumn(f"_{plan}", F.explode_outer(f"_{plan}"))
        if code:
            out = out.withColumn(code, F.col(f"_{plan}.code").cast("string"))
        out = out.withColumn(descr, F.col(f"_{plan}.descr")).drop(f"_{plan}")
    return out


def _criteria(t207: DataFrame, t206: DataFrame, t204: DataFrame) -> DataFrame:
    """Criteria with their descriptions, once for all plans. The plan table adds
    no column, but a plan listed several times repeats its rows, as joins with
    it would."""
    known = t206.select(F.col("F206_ID_CIA").alias("cia"), F.col("F206_ID_PLAN").alias("plan"),
                        F.col("F206_ID").alias("crit"), F.col("F206_ID").alias("code"),
                        F.col("F206_DESCRIPCION").alias("descr"))
    copies = (t204.groupBy(F.col("F204_ID_CIA").alias("cia"), F.col("F204_ID").alias("plan"))
              .agg(F.count(F.lit(1)).cast("int").alias("copies")))
    rows = t207.select(F.col("F207_ID_CIA").alias("cia"), F.col("F207_ROWID_TERCERO").alias("third"),
                       F.col("F207_ID_SUCURSAL").alias("branch"), F.col("F207_ID_PLAN_CRITERIOS").alias("plan"),
                       F.col("F207_ID_CRITERIO_MAYOR").alias("crit"))
    # the two small tables meet first, so the criteria of all clients are joined once
    rows = rows.join(known.join(copies, ["cia", "plan"], "left"), ["cia", "plan", "crit"], "left")
    times = F.when(F.col("code").isNull(), 1).otherwise(F.coalesce("copies", F.lit(1)))
    return (rows.withColumn("_i", F.explode(F.array_repeat(F.lit(1), times)))
            .select("third", "branch", "plan", "code", "descr"))


def client_extract(t200: DataFrame, t201: DataFrame, t750: DataFrame, t752: DataFrame,
                   t742: DataFrame, t753: DataFrame, t743: DataFrame, t207: DataFrame,
                   t206: DataFrame, t204: DataFrame, company: int = COMPANY_ID,
                   entities=ENTITY_IDS) -> DataFrame:
    """Q01: the 18-column client table.

    Customers of the company with their third party (J20), the movement rows of
    the kept entities (F06), longitude and latitude among the rows' attributes
    (J22, J23), and the criteria of four plans (J21), which are joined once and
    opened per plan.
    """
    from visitwise.operators.eav import LATITUDE_ATTRS, LONGITUDE_ATTRS
    third = t200.where(F.col("F200_ID_CIA") == company).select(
        F.col("F200_ID_CIA").alias("COD_CIA"), F.col("F200_ROWID").alias("ROWID_TERCERO"),
        F.col("F200_NIT").alias("NIT_TERCERO"), F.col("F200_RAZON_SOCIAL").alias("RAZON_SOCIAL"))
    customer = t201.select(
        F.col("F201_ID_CIA").alias("COD_CIA"), F.col("F201_ROWID_TERCERO").alias("ROWID_TERCERO"),
        F.col("F201_ID_SUCURSAL").alias("COD_SUCURSAL_CLIENTE"),
        F.col("F201_DESCRIPCION_SUCURSAL").alias("DES_SUCURSAL_CLIENTE"),
        F.col("F201_IND_ESTADO_ACTIVO").alias("IND_ESTADO_ACTIVO_CLIENTE"),
        F.col("F201_ID_CO_FACTURA").alias("COD_CO"), F.col("F201_ROWID_MOVTO_ENTIDAD").alias("_mov"))
    rows = (t752.select(F.col("F752_ROWID").alias("_fila"), F.col("F752_ROWID_MOVTO_ENTIDAD").alias("_mov"),
                        F.col("F752_ROWID_ENTIDAD").alias("_ent")).where(F.col("_ent").isin(*entities))
            .join(t742.select(F.col("F742_ROWID").alias("_ent")), "_ent")
            .join(t750.select(F.col("F750_ROWID").alias("_mov")), "_mov"))
    place = ["_ent", "_fila", "_mov"]
    located = (rows.join(_coordinate_rows(t752, t742, t753, t743, LONGITUDE_ATTRS, "LONGITUD"), place)
               .join(_coordinate_rows(t752, t742, t753, t743, LATITUDE_ATTRS, "LATITUD"), place))
    key = ["ROWID_TERCERO", "COD_SUCURSAL_CLIENTE"]
    lists = (criteria_lists(_criteria(t207, t206, t204), ["third", "branch"])
             .withColumnsRenamed({"third": key[0], "branch": key[1]}))
    found = with_criteria(third.join(customer, ["COD_CIA", "ROWID_TERCERO"]).join(located, "_mov"), lists, key)
    return found.withColumn("ID_TERCERO", concat_strict("NIT_TERCERO", "COD_SUCURSAL_CLIENTE", sep="-")).select(
        "COD_CIA", "ROWID_TERCERO", "NIT_TERCERO", "ID_TERCERO", "RAZON_SOCIAL", "COD_SUCURSAL_CLIENTE",
        "DES_SUCURSAL_CLIENTE", "IND_ESTADO_ACTIVO_CLIENTE", "COD_DIA_VISITA", "DES_DIA_VISITA", "COD_CO",
        "COD_FRECUENCIA_VISITA", "DES_FRECUENCIA_VISITA", "COD_VENDEDOR", "DES_VENDEDOR", "COD_CANAL",
        "LONGITUD", "LATITUD")


def calendar_load(spark, csv_path: str, out_path: str) -> DataFrame:
    """Q03: the calendar file, every column as text, landed as parquet."""
    from visitwise.sources.files import read_csv_text
    from visitwise.sources.sinks import write_parquet
    cal = read_csv_text(spark, csv_path)
    write_parquet(cal.toDF(*[c.strip().replace(" ", "_") for c in cal.columns]), out_path)
    return spark.read.parquet(out_path)


# Source table names of the two extracts.
CLIENT_SOURCE_TABLES = {"t200": "T200_MM_TERCEROS", "t201": "T201_MM_CLIENTES",
                        "t750": "T750_MM_MOVTO_ENTIDAD", "t752": "T752_MM_MOVTO_ENTIDAD_FILA",
                        "t742": "T742_MM_ENTIDAD", "t753": "T753_MM_MOVTO_ENTIDAD_COLUMNA",
                        "t743": "T743_MM_ENTIDAD_ATRIBUTO", "t207": "T207_MM_CRITERIOS_CLIENTES",
                        "t206": "T206_MM_CRITERIOS_MAYORES", "t204": "T204_MM_PLANES_CRITERIOS"}
VISIT_SOURCE_TABLES = {"visita": "VISITA", "usuario": "USUARIO", "sucursal": "SUCURSAL"}


def extract_from(reader, which: str = "clients") -> DataFrame:
    """Q01 / Q02 from any table reader: ``reader(table_name) -> DataFrame``,
    e.g. ``lambda t: spark.read.parquet(f"{base}/{t}")`` for landed copies or
    ``lambda t: sources.jdbc.read_table(spark, t, ...)`` for the server."""
    if which == "clients":
        return client_extract(**{k: reader(v) for k, v in CLIENT_SOURCE_TABLES.items()})
    t = {k: reader(v) for k, v in VISIT_SOURCE_TABLES.items()}
    return visit_extract(t["visita"], t["usuario"], t["sucursal"])
