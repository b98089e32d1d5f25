"""The expressions and comparisons as functions of a session, to be called from SQL.

Bodies are SQL over named tables or views, looked up anew at each call, so a function sees what its tables hold then.
They last as long as the session. Each gives what the Python function of its name gives.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from namewright.functions import SHORT_KEY_CHARS
from namewright.operators.reconcile import KeyPairs
from namewright.sources.tables import require

#: name, parameters, result type, body
SCALARS = (
    ("norm_key", "value STRING", "STRING", "trim(lower(value))"),
    ("not_blank", "value STRING", "BOOLEAN", "value IS NOT NULL AND length(trim(value)) > 0"),
    ("differs", "a STRING, b STRING", "BOOLEAN", "NOT (a <=> b)"),
    (
        "short_key",
        "value STRING",
        "STRING",
        f"CASE WHEN length(value) <= {SHORT_KEY_CHARS} THEN value ELSE concat('sha256:', sha2(value, 256)) END",
    ),
    ("iso_utc", "at TIMESTAMP", "STRING", "date_format(to_utc_timestamp(at, current_timezone()), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"),
    (
        "stable_id",
        "prefix STRING, value STRING, width INT DEFAULT 16",
        "STRING",
        "concat(prefix, substring(md5(coalesce(value, '\\u0000')), 1, width))",
    ),
)


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _norm(column: str) -> str:
    return f"trim(lower(CAST({_quoted(column)} AS STRING)))"


def _table_function(spark: SparkSession, name: str, parameters: str, body: str, columns: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {_quoted(name)}({parameters}) RETURNS TABLE({columns}) RETURN {body}")


def register_scalars(spark: SparkSession) -> list[str]:
    """Make the scalar functions known to the session; returns their names.

    They take text: other types are cast by the caller's query. ``stable_id`` hashes one value; give several as one text.
    """
    for name, parameters, result, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [name for name, *_ in SCALARS]


def register_comparison(spark: SparkSession, name: str, left: str, right: str, keys: KeyPairs) -> None:
    """``SELECT * FROM name()`` compares the tables as compare_tables_by_keys() does, ``name('match')`` gives one type.

    Each side is counted by its keys and spelling before the join, so a key that is held by a third of both tables is
    joined as one row each. A type given as an argument is a constant, so Spark can drop the sides it does not need.
    """
    if not keys:
        raise ValueError("at least one key pair is needed")
    require(spark.table(left), [k for k, _ in keys], "left table")
    require(spark.table(right), [k for _, k in keys], "right table")

    def counted(table: str, cols: list[str], side: str) -> str:
        normed = ", ".join(f"{_norm(c)} AS k{i}" for i, c in enumerate(cols))
        first = _quoted(cols[0])
        return (
            f"SELECT {normed}, CAST({first} AS STRING) AS uuid_{side}, count(*) AS n FROM {table} "
            f"WHERE {first} IS NOT NULL GROUP BY ALL"
        )

    same = " AND ".join(f"a.k{i} = b.k{i}" for i in range(len(keys)))
    blank_left, blank_right = (_quoted(k) for k in keys[0])
    body = f"""
        SELECT match_type, uuid_left, uuid_right, pairs FROM (
            SELECT CASE WHEN uuid_left IS NULL THEN 'only_in_right' WHEN uuid_right IS NULL THEN 'only_in_left'
                        ELSE 'match' END AS match_type,
                   uuid_left, uuid_right, sum(coalesce(a.n, 1) * coalesce(b.n, 1)) AS pairs
            FROM ({counted(left, [k for k, _ in keys], "left")}) a
            FULL OUTER JOIN ({counted(right, [k for _, k in keys], "right")}) b ON {same}
            GROUP BY uuid_left, uuid_right
            UNION ALL
            SELECT 'unknown', NULL, NULL, count(*) FROM (
                SELECT 1 FROM {left} WHERE {blank_left} IS NULL UNION ALL SELECT 1 FROM {right} WHERE {blank_right} IS NULL)
            HAVING count(*) > 0)
        WHERE wanted IS NULL OR match_type = wanted"""
    columns = "match_type STRING, uuid_left STRING, uuid_right STRING, pairs BIGINT"
    _table_function(spark, name, "wanted STRING DEFAULT NULL", body, columns)


def register_preview(
    spark: SparkSession,
    name: str,
    incoming: str,
    existing: str,
    keys: KeyPairs,
    projection: dict[str, str],
    id_col: str,
    time_col: str = "last_update",
) -> None:
    """``SELECT * FROM name()`` gives the rows of ``incoming`` without a match, as preview_new_rows() does.

    ``projection`` names the target columns, each an SQL expression over ``incoming``. Arguments of the function, both
    optional: the prefix of the ids (``new:``), and the load time (now).
    """
    source = spark.table(incoming)
    require(source, [k for k, _ in keys], "incoming")
    require(spark.table(existing), [k for _, k in keys], "existing")
    marked = ", ".join(f"coalesce(CAST(a.{_quoted(c)} AS STRING), '\\u0000')" for c in sorted(source.columns))
    present = ", ".join(f"{_norm(k)} AS n{i}" for i, (_, k) in enumerate(keys))
    same = " AND ".join(f"trim(lower(CAST(a.{_quoted(k)} AS STRING))) = b.n{i}" for i, (k, _) in enumerate(keys))
    projected = ", ".join(f"{text} AS {_quoted(col)}" for col, text in projection.items())
    types = {field.name: field.dataType.simpleString() for field in source.selectExpr(*[f"{t} AS {_quoted(c)}" for c, t in projection.items()]).schema}
    body = f"""
        SELECT concat(prefix, substring(md5(concat_ws('\\u001f', {marked})), 1, 16)), {projected}, coalesce(at, current_timestamp())
        FROM {incoming} a LEFT ANTI JOIN (SELECT DISTINCT {present} FROM {existing}) b ON {same}"""
    fields = [f"{_quoted(id_col)} STRING", *[f"{_quoted(c)} {types[c]}" for c in projection], f"{_quoted(time_col)} TIMESTAMP"]
    _table_function(spark, name, f"prefix STRING DEFAULT {_literal('new:')}, at TIMESTAMP DEFAULT NULL", body, ", ".join(fields))
