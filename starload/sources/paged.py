"""Paged API source and request plans.

``PagedSource`` is a Python data source. One parameter becomes one or more read
tasks; with ``readers`` above one, task ``k`` reads pages ``k, k + readers, ...``
so that a parameter with very many pages is not bound to a single task. Each row
is one request: its status and, on success, the records of the page as JSON text.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

UNLIMITED = -1
OK = 200
NOT_FOUND = 404
PAGE_BLOCK = 10_000

REQUESTS = T.StructType(
    [
        T.StructField("param", T.StringType()),
        T.StructField("reader", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("page", T.LongType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("is_end", T.BooleanType()),
        T.StructField("gave_up", T.BooleanType()),
        T.StructField("records", T.ArrayType(T.StringType())),
    ]
)

# fetch(param, page, page_size) -> (status, records of the page or None)
Fetch = Callable[[str, int, int], tuple[int, list | None]]


@dataclass(frozen=True)
class Limits:
    """When to give up on a parameter; ``-1`` means never."""

    errors: int = UNLIMITED
    consecutive_errors: int = 5
    executions: int = UNLIMITED

    def reached(self, errors: int, consecutive: int, executions: int) -> bool:
        pairs = ((errors, self.errors), (consecutive, self.consecutive_errors), (executions, self.executions))
        return any(limit != UNLIMITED and count >= limit for count, limit in pairs)


@dataclass
class ReaderShare(InputPartition):
    param: str
    reader: int


def _ended(stop_on: str, status: int, records: list | None) -> bool:
    if stop_on == "not_found":
        return status == NOT_FOUND
    return status == OK and not records


class _PagedReader(DataSourceReader):
    def __init__(self, params, fetch, page_size, readers, stop_on, limits, back_off, on_limit):
        self.params, self.fetch, self.page_size = params, fetch, page_size
        self.readers, self.stop_on, self.limits, self.back_off = readers, stop_on, limits, back_off
        self.on_limit = on_limit

    def partitions(self):
        return [ReaderShare(param, k) for param in self.params for k in range(self.readers)]

    def read(self, share: ReaderShare) -> Iterator[tuple]:
        page, seq = share.reader, 0
        errors = consecutive = executions = 0
        while True:
            status, records = self.fetch(share.param, page, self.page_size)
            if _ended(self.stop_on, status, records):
                yield share.param, share.reader, seq, page, status, True, False, None
                return
            executions += 1
            good = status == OK
            errors, consecutive = errors + (not good), 0 if good else consecutive + 1
            stop = self.limits.reached(errors, consecutive, executions)
            if stop and self.on_limit == "raise":
                raise RuntimeError(
                    f"gave up on {share.param!r} at page {page}: {executions} executions, {errors} errors,"
                    f" {consecutive} of them in a row, and no end of the data"
                )
            texts = [json.dumps(record, default=str) for record in records or []] if good else None
            yield share.param, share.reader, seq, page, status, False, stop, texts
            if stop:
                return
            if good:
                page += self.readers
            else:
                time.sleep(self.back_off * (1 + consecutive))
            seq += 1


def read_pages(
    spark: SparkSession,
    params: list[str],
    fetch: Fetch,
    page_size: int = 100,
    readers: int = 1,
    stop_on: str = "empty",
    limits: Limits = Limits(),
    back_off: float = 1.0,
    on_limit: str = "raise",
) -> DataFrame:
    """Requests made for each parameter until its data ends, one row per request.

    A reader that meets a limit before the end fails the job, or with ``on_limit="mark"``
    marks its last request with ``gave_up``; the audit then names the parameter as incomplete.
    ``stop_on`` is ``"empty"`` (a page without records ends the data) or
    ``"not_found"`` (only status 404 does). ``fetch`` must be picklable. Limits on
    all errors or executions count a whole parameter, so they need one reader.
    """
    if stop_on not in ("empty", "not_found"):
        raise ValueError(f"unknown end rule {stop_on!r}")
    if on_limit not in ("raise", "mark"):
        raise ValueError(f"unknown rule {on_limit!r} for limits")
    if readers > 1 and (limits.errors != UNLIMITED or limits.executions != UNLIMITED):
        raise ValueError("limits on total errors or executions need readers=1")
    texts = [str(param) for param in params]

    class PagedSource(DataSource):
        @classmethod
        def name(cls):
            return "starload_pages"

        def schema(self):
            return REQUESTS

        def reader(self, schema):
            return _PagedReader(texts, fetch, page_size, readers, stop_on, limits, back_off, on_limit)

    spark.dataSource.register(PagedSource)
    return spark.read.format("starload_pages").load()


def page_records(requests: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of all pages, parsed with an explicit schema, next to their parameter."""
    parsed = requests.select("param", F.explode("records").alias("record")).select(
        "param", F.from_json("record", schema, {"mode": "FAILFAST"}).alias("record")
    )
    return parsed.select("param", "record.*")


def request_url(base: str, endpoint: str, parameters: dict[str, Column | str], escape: bool = False) -> Column:
    """URL of a request: base, endpoint and the parameters in their given order."""
    pairs = []
    for name, value in parameters.items():
        text = value.cast("string") if isinstance(value, Column) else F.lit(str(value))
        pairs.append(F.concat(F.lit(f"{name}="), F.url_encode(text) if escape else text))
    head = F.lit(base + endpoint)
    return F.concat(head, F.lit("?"), F.concat_ws("&", *pairs)) if pairs else head


def request_plan(
    spine: DataFrame, base: str, endpoint: str, param_name: str, pages: Column, page_size: int = 100
) -> DataFrame:
    """One row per request: each parameter with its page numbers from zero.

    Pages are made in two steps, blocks and then the pages of a block, with the blocks
    dealt out in between: a parameter with very many pages neither builds one huge
    array nor stays in one task.
    """
    last = (pages - 1).cast("int")
    blocks = spine.select(
        "param", last.alias("_last"), F.explode(F.sequence(F.lit(0), F.floor(last / PAGE_BLOCK))).alias("_block")
    ).repartition("param", "_block")
    first = (F.col("_block") * PAGE_BLOCK).cast("int")
    within = F.sequence(first, F.least(F.col("_last"), first + (PAGE_BLOCK - 1)))
    numbered = blocks.select("param", F.explode(within).alias("page"))
    parameters = {"pagina": F.col("page"), "tamanhoDaPagina": str(page_size), param_name: F.col("param")}
    return numbered.withColumn("url", request_url(base, endpoint, parameters))
