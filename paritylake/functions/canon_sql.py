"""The canonical form of ``canon.py`` written as SQL text (DuckDB dialect).

Used to state oracle queries for the correctness gate: the same value rules,
tokens, md5 lanes and digests, so a Spark digest can be checked against an
independent engine. Types are given as simple names (``int``, ``double``,
``decimal``, ``string``, ``bool``, ``date``, ``timestamp``, ``list<double>``).
"""

from __future__ import annotations

from paritylake.functions.canon import FLOAT_DECIMALS, LANE_HEX_DIGITS, NULL_TOKEN


def stripped_sql(text: str) -> str:
    """Plain decimal text without trailing zeros after its point."""
    return f"(CASE WHEN contains({text}, '.') THEN rtrim(rtrim({text}, '0'), '.') ELSE {text} END)"


def text_sql(expr: str, typ: str, float_decimals: int = FLOAT_DECIMALS) -> str:
    if typ in ("int", "bigint", "string_int"):
        return f"CAST({expr} AS VARCHAR)"
    if typ in ("double", "float"):
        d = f"CAST({expr} AS DOUBLE)"
        unit = 10 ** float_decimals
        r = f"CAST(round({d} * {float(unit)}) AS HUGEINT)"
        plain = (f"(CASE WHEN {r} < 0 THEN '-' ELSE '' END || CAST(abs({r}) // {unit} AS VARCHAR) || '.' || "
                 f"lpad(CAST(abs({r}) % {unit} AS VARCHAR), {float_decimals}, '0'))")
        return (f"(CASE WHEN isnan({d}) THEN 'NaN' WHEN {d} = 'inf'::DOUBLE THEN 'Inf' "
                f"WHEN {d} = '-inf'::DOUBLE THEN '-Inf' ELSE {stripped_sql(plain)} END)")
    if typ == "decimal":
        return stripped_sql(f"CAST({expr} AS VARCHAR)")
    if typ == "string":
        return f"{expr}"
    if typ in ("bool", "date"):
        return f"CAST({expr} AS VARCHAR)"
    if typ == "timestamp":
        return f"CAST(epoch_us({expr}) // 1000000 AS VARCHAR)"
    if typ.startswith("list<") and typ.endswith(">"):
        et = typ[5:-1]
        return (f"('[' || array_to_string(list_transform({expr}, lambda x: "
                f"{token_sql('x', et, float_decimals)}), ',') || ']')")
    raise TypeError(typ)


_FIXED = ("int", "bigint", "double", "float", "decimal", "bool", "date", "timestamp")


def token_sql(expr: str, typ: str, float_decimals: int = FLOAT_DECIMALS) -> str:
    t = text_sql(expr, typ, float_decimals)
    if typ in _FIXED:
        return f"(CASE WHEN {expr} IS NULL THEN '{NULL_TOKEN}' ELSE {t} END)"
    return (f"(CASE WHEN {expr} IS NULL THEN '{NULL_TOKEN}' ELSE "
            f"CAST(length({t}) AS VARCHAR) || ':' || {t} END)")


def row_text_sql(cols: list[tuple[str, str]]) -> str:
    return "concat_ws(',', " + ", ".join(token_sql(c, t) for c, t in cols) + ")"


def lane_sql(md5_expr: str, lane: int) -> str:
    start = 1 + (lane - 1) * LANE_HEX_DIGITS
    return f"('0x' || substr({md5_expr}, {start}, {LANE_HEX_DIGITS}))::BIGINT"


def hash_cols_sql(cols: list[tuple[str, str]]) -> str:
    """`h1, h2` select items for a row over ``cols``."""
    m = f"md5({row_text_sql(cols)})"
    return f"{lane_sql(m, 1)} AS h1, {lane_sql(m, 2)} AS h2"


def digest_aggs_sql(prefix: str = "") -> str:
    return (f"CAST(count(*) AS BIGINT) AS {prefix}n, "
            f"CAST(coalesce(sum(h1), 0) AS DECIMAL(38,0)) AS {prefix}s1, "
            f"CAST(coalesce(sum(h2), 0) AS DECIMAL(38,0)) AS {prefix}s2, "
            f"CAST(coalesce(bit_xor(h1), 0) AS BIGINT) AS {prefix}x")


def bucket_sql(key_expr: str, n_buckets: int) -> str:
    kh = f"('0x' || substr(md5(CAST({key_expr} AS VARCHAR)), 1, {LANE_HEX_DIGITS}))::BIGINT"
    return (f"CAST(CASE WHEN {key_expr} IS NULL THEN -1 ELSE "
            f"(({kh} % {n_buckets}) + {n_buckets}) % {n_buckets} END AS INTEGER)")
