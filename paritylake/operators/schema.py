"""V13 schema conformance proven on data.

Declared columns are compared with the DataFrame schema (existence,
case-insensitive; logical type after normalising dialect spellings; nested
signature; NUMERIC must declare a scale) and with a one-scan column profile
(NULL count, largest decimal scale actually used) — needed because a
``NOT NULL`` Parquet column still reports ``nullable=true``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paritylake.checks import CHECKS_DDL

# fixed values: dialect spellings of each logical type
TYPE_FAMILIES = {
    "INT64": ["tinyint", "smallint", "int", "integer", "bigint", "int64", "long", "short", "byte"],
    "FLOAT64": ["float", "double", "double precision", "real", "float64"],
    "NUMERIC": ["decimal", "numeric", "bignumeric"],
    "STRING": ["string", "varchar", "char", "text"],
    "BYTES": ["binary", "bytes"],
    "BOOL": ["boolean", "bool"],
    "TIMESTAMP": ["timestamp", "timestamp_ltz", "timestamp_ntz", "datetime"],
    "DATE": ["date"],
}
_SPELLING = {s: fam for fam, spellings in TYPE_FAMILIES.items() for s in spellings}
_PARAMS = re.compile(r"^\s*([a-z_ ]+?)\s*(\(\s*(\d+)\s*(,\s*(\d+)\s*)?\))?\s*$")


def logical_type(spelling: str) -> tuple[str, int | None]:
    """'decimal(12,2)' → ('NUMERIC', 2); 'array<struct<a:int>>' → nested text."""
    s = spelling.strip().lower()
    if s.startswith(("array<", "struct<", "map<")):
        return nested_signature(s), None
    m = _PARAMS.match(s)
    if not m:
        return s.upper(), None
    base = m.group(1).strip()
    fam = _SPELLING.get(base, base.upper())
    scale = int(m.group(5)) if m.group(5) else (0 if m.group(3) and fam == "NUMERIC" else None)
    return fam, scale


def nested_signature(s: str) -> str:
    """Canonical nested text: scalar spellings normalised, field names lower-cased."""
    s = s.replace(" ", "").lower()
    out, token = [], ""
    for ch in s:
        if ch in "<>,:":
            if token:
                out.append(_SPELLING.get(token, token))
                token = ""
            out.append(ch)
        else:
            token += ch
    if token:
        out.append(_SPELLING.get(token, token))
    containers = {"array", "struct", "map"}
    return "".join(x.upper() if x in TYPE_FAMILIES or x in containers else x for x in out)


def spark_logical(dt: T.DataType) -> tuple[str, int | None]:
    if isinstance(dt, T.DecimalType):
        return "NUMERIC", dt.scale
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        return nested_signature(dt.simpleString()), None
    return logical_type(dt.simpleString())


def used_scale(c, dt: T.DataType):
    """Decimal places a numeric value uses: exact for decimals, those of the shortest form for floats (a float too large
    for 20 digits before the point uses none)."""
    plain = c.cast("string") if isinstance(dt, T.DecimalType) else c.cast("double").try_cast("decimal(38,18)").cast("string")
    frac = F.when(F.instr(plain, ".") > 0, F.substring_index(plain, ".", -1)).otherwise(F.lit(""))
    return F.when(c.isNotNull(), F.coalesce(F.length(F.rtrim(frac, F.lit("0"))), F.lit(0)))


def _null_inside(c, dt: T.DataType):
    """Does a nested value hold a NULL element or field anywhere?"""
    if isinstance(dt, T.ArrayType):
        return F.exists(c, lambda x: x.isNull() | F.coalesce(_null_inside(x, dt.elementType), F.lit(False)))
    if isinstance(dt, T.StructType):
        found = F.lit(False)
        for f in dt.fields:
            x = c.getField(f.name)
            found = found | x.isNull() | F.coalesce(_null_inside(x, f.dataType), F.lit(False))
        return found
    if isinstance(dt, T.MapType):
        return F.exists(F.map_values(c), lambda x: x.isNull() | F.coalesce(_null_inside(x, dt.valueType), F.lit(False)))
    return F.lit(False)


def column_profile(df: DataFrame) -> DataFrame:
    """ONE aggregate over the table: rows, NULLs per column, max used scale of
    numeric columns, rows of nested columns with a NULL inside → long form
    (col, rows, nulls, max_scale, inner_nulls)."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("_rows")]
    numeric, nested = [], []
    for f in df.schema.fields:
        aggs.append(F.count_if(F.col(f.name).isNull()).cast("bigint").alias(f"n_{f.name}"))
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            aggs.append(F.max(used_scale(F.col(f.name), f.dataType)).cast("int").alias(f"s_{f.name}"))
            numeric.append(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            aggs.append(F.count_if(_null_inside(F.col(f.name), f.dataType)).cast("bigint").alias(f"i_{f.name}"))
            nested.append(f.name)
    one = df.agg(*aggs)
    parts = ", ".join(f"'{f.name}', `n_{f.name}`, " + (f"`s_{f.name}`" if f.name in numeric else "CAST(NULL AS INT)")
                      + ", " + (f"`i_{f.name}`" if f.name in nested else "CAST(NULL AS BIGINT)") for f in df.schema.fields)
    return one.selectExpr("_rows AS rows", f"stack({len(df.schema.fields)}, {parts}) AS (col, nulls, max_scale, inner_nulls)")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True
    inner_nullable: bool = True
    source_type: str | None = None


def type_map_check(table_name: str, spec: ColumnSpec, type_map: dict[str, str]) -> tuple | None:
    """A column's declared type against the type its source type maps to; an unmapped source type FAILs."""
    if spec.source_type is None:
        return None
    want = type_map.get(spec.source_type.lower())
    got = logical_type(spec.type)[0]
    return ("schema_conformance", f"{table_name}.{spec.name}:source_type", "PASS" if want and logical_type(want)[0] == got else "FAIL",
            logical_type(want)[0] if want else f"no mapping of {spec.source_type}", got, False)


def fk_type_agreement(spark: SparkSession, paths: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Join paths (name, child, child column, parent, parent column): both keys must have one logical type."""
    rows = []
    for name, child, cc, parent, pc in paths:
        a, b = spark_logical(child.schema[cc].dataType)[0], spark_logical(parent.schema[pc].dataType)[0]
        rows.append(("schema_conformance", f"join:{name}", "PASS" if a == b else "FAIL", b, a, False))
    return spark.createDataFrame(rows, CHECKS_DDL)


def schema_conformance(spark: SparkSession, df: DataFrame, table_name: str,
                       expected: list[ColumnSpec], type_map: dict[str, str] | None = None) -> DataFrame:
    """Check rows for one table: exists / type / source type map / scale declared / not-null on
    data / scale on data / no NULL inside nested values, per declared column."""
    actual = {f.name.lower(): f for f in df.schema.fields}
    meta_rows = []
    data_specs = []
    for spec in expected:
        tgt = f"{table_name}.{spec.name}"
        f = actual.get(spec.name.lower())
        if f is None:
            meta_rows.append(("schema_conformance", f"{tgt}:exists", "FAIL", "present", "missing", False))
            continue
        meta_rows.append(("schema_conformance", f"{tgt}:exists", "PASS", "present", "present", False))
        efam, escale = logical_type(spec.type)
        afam, ascale = spark_logical(f.dataType)
        ok = efam == afam and (efam != "NUMERIC" or escale is None or ascale is None or escale == ascale)
        meta_rows.append(("schema_conformance", f"{tgt}:type", "PASS" if ok else "FAIL", efam, afam, False))
        mapped = type_map_check(table_name, spec, type_map or {})
        if mapped:
            meta_rows.append(mapped)
        if efam == "NUMERIC" and escale is None:
            meta_rows.append(("schema_conformance", f"{tgt}:scale_declared", "FAIL", "scale", "none", False))
        data_specs.append((spec, f, escale if efam in ("NUMERIC", "FLOAT64") else None))
    meta = spark.createDataFrame(meta_rows, CHECKS_DDL)
    if not data_specs:
        return meta
    # one profile scan; each column's data checks come out of one explode
    prof = column_profile(df.select(*[f.name for _, f, _ in data_specs]))
    specs_df = spark.createDataFrame(
        [(f.name, f"{table_name}.{spec.name}", not spec.nullable, escale, not spec.inner_nullable) for spec, f, escale in data_specs],
        "col string, tgt string, nn boolean, escale int, inn boolean")
    j = prof.join(F.broadcast(specs_df), "col")
    mk = lambda name, ok, exp, act: F.struct(
        F.concat(F.col("tgt"), F.lit(f":{name}")).alias("target"),
        F.when(ok, "PASS").otherwise("FAIL").alias("status"),
        exp.cast("string").alias("expected"), act.cast("string").alias("actual"))
    checks = F.array_compact(F.array(
        F.when(F.col("nn"), mk("not_null_on_data", F.col("nulls") == 0, F.lit("0"), F.col("nulls"))),
        F.when(F.col("escale").isNotNull(),
               mk("scale_on_data", F.coalesce(F.col("max_scale"), F.lit(0)) <= F.col("escale"),
                  F.col("escale"), F.col("max_scale"))),
        F.when(F.col("inn"), mk("no_null_inside_on_data", F.coalesce(F.col("inner_nulls"), F.lit(0)) == 0, F.lit("0"), F.col("inner_nulls")))))
    data = j.select(F.explode(checks).alias("c")).select(
        F.lit("schema_conformance").alias("pattern"), "c.target", "c.status", "c.expected", "c.actual",
        F.lit(False).alias("measurement"))
    return meta.unionByName(data)


def table_count(spark: SparkSession, pattern: str, expected: int) -> DataFrame:
    """Exact number of tables whose name matches ``pattern`` in the current schema."""
    n = spark.sql(f"SHOW TABLES LIKE '{pattern}'").where("not isTemporary").count()
    return spark.createDataFrame([("schema_conformance", f"{pattern}:tables", "PASS" if n == expected else "FAIL", str(expected), str(n), False)], CHECKS_DDL)


def table_metadata_checks(spark: SparkSession, table_name: str, partitions: list[str] | None = None,
                          retention_days: float | None = None, labels: dict | None = None,
                          must_not_be_external: bool = False, table_type: str | None = None, description: str | None = None,
                          cluster: list[str] | None = None, require_partition_filter: bool | None = None,
                          label: str | None = None) -> DataFrame:
    """V13 catalog part: the table is there; partition columns (exact, ordered), cluster columns (exact, ordered),
    retention in days (±0.5), label subset, object type, external flag, description and whether queries must filter on
    the partition, read from the catalog and TBLPROPERTIES (metadata only — a handful of rows on the driver)."""
    shown = label or table_name
    rows = []

    def check(what: str, ok: bool, expected, got) -> None:
        rows.append(("schema_conformance", f"{shown}:{what}", "PASS" if ok else "FAIL", str(expected), str(got), False))

    there = spark.catalog.tableExists(table_name)
    check("exists", there, "present", "present" if there else "missing")
    if not there:
        return spark.createDataFrame(rows, CHECKS_DDL)
    cols = spark.catalog.listColumns(table_name)
    facts = spark.catalog.getTable(table_name)
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table_name}").collect()}
    if partitions is not None:
        got = [c.name for c in cols if c.isPartition]
        check("partitions", got == partitions, ",".join(partitions), ",".join(got))
    if cluster is not None:
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()}
        got = [c.strip("` ") for c in described.get("Bucket Columns", "[]").strip("[]").split(",") if c.strip("` ")]
        check("cluster", got == cluster, ",".join(cluster), ",".join(got))
    if retention_days is not None:
        got = props.get("retention_days")
        check("retention_days", got is not None and abs(float(got) - retention_days) <= 0.5, retention_days, got)
    if labels is not None:
        have = dict(kv.split("=", 1) for kv in props.get("labels", "").split(",") if "=" in kv)
        check("labels", all(have.get(k) == v for k, v in labels.items()),
              ",".join(f"{k}={v}" for k, v in sorted(labels.items())), ",".join(f"{k}={v}" for k, v in sorted(have.items())))
    kind = "VIEW" if facts.tableType == "VIEW" else "TABLE"
    if table_type is not None:
        check("type", kind == table_type, table_type, kind)
    if must_not_be_external:
        check("not_external", facts.tableType != "EXTERNAL", "MANAGED", facts.tableType)
    if description is not None:
        check("description", facts.description == description, description, facts.description)
    if require_partition_filter is not None:
        got = props.get("require_partition_filter", "false") == "true"
        check("require_partition_filter", got == require_partition_filter, require_partition_filter, got)
    return spark.createDataFrame(rows, CHECKS_DDL)
