from pyspark.sql import DataFrame

from namewright.plans.joins import Limits

# Nothing may be broadcast but the rows of hot keys, and three rows make a key hot.
TIGHT = Limits(broadcast_rows=0, broadcast_bytes=0, hot_rows=3)

# Nothing may be broadcast and no key is hot.
SHUFFLED = Limits(broadcast_rows=0, broadcast_bytes=0)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(a: DataFrame, b: DataFrame) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
