"""A user's line parser as a table function that SQL can name."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


def register_parser(spark: SparkSession, name: str, parser: Callable[[str], Iterable[tuple] | None], returns: str) -> None:
    """Makes `name(line)` a table function of the session: parser turns a line into rows of the columns `returns`, or into none (None
    or an empty list). In SQL: select t.* from lines, lateral name(lines.value) t. A null line has no rows."""

    class Parser:
        def eval(self, line: str):
            if line is not None:
                yield from parser(line) or ()

    spark.udtf.register(name, udtf(Parser, returnType=returns))
