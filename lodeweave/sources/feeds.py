"""Readers and writers of raw feeds: envelopes, registries, lines of JSON, and paged feeds.

An envelope is one collected cycle: a header and its records, one gzip JSON
file under Hive-style folders. Reading is a scan with an explicit schema.
"""

from __future__ import annotations

import gzip
import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lodeweave.session import SharedPath

HEADER = "schema_name string, schema_version int, provider string, source string, object_type string, ingest_run_id string, ingested_at timestamp"
FOLDERS = ["provider", "source", "object", "schema", "date", "hour"]


def folder_columns(provider: Column, source: Column, kind: Column, version: Column, at: Column) -> dict[str, Column]:
    """The folders of an envelope; times in UTC."""
    return {"provider": provider, "source": source, "object": kind, "schema": F.concat(F.lit("v"), version.cast("string")), "date": F.date_format(at, "yyyy-MM-dd"), "hour": F.date_format(at, "HH")}


def write_envelopes(df: DataFrame, path: str) -> None:
    """Writes rows (the header's columns and ``records``) as gzip JSON under their folders; derived columns begin with _ and are left out."""
    kept = df.select(*[c for c in df.columns if not c.startswith("_")])
    places = folder_columns(*[F.col(c) for c in ("provider", "source", "object_type", "schema_version", "ingested_at")])
    out = kept.withColumn("header_provider", F.col("provider")).withColumn("header_source", F.col("source")).withColumns(places)
    out.write.mode("append").partitionBy(*FOLDERS).option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def read_envelopes(spark: SparkSession, path: str, records: str, name: str, version: int, start: str | None = None, end: str | None = None) -> DataFrame:
    """Envelopes of a schema and version, ``records`` being their DDL; another schema in the scan is an error, not a silent gap.

    ``start`` and ``end`` are dates, both included, by which folders are pruned.
    """
    shape = f"schema_name string, schema_version int, object_type string, ingest_run_id string, ingested_at timestamp, header_provider string, header_source string, records {records}, provider string, source string, object string, schema string, date date, hour string"
    rows = spark.read.schema(shape).option("mode", "FAILFAST").json(path)
    if start:
        rows = rows.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        rows = rows.where(F.col("date") <= F.lit(end).cast("date"))
    wrong = (F.col("schema_name") != name) | (F.col("schema_version") != version)
    return rows.withColumn("schema_name", F.when(wrong, F.raise_error(F.concat(F.lit("unexpected envelope "), "schema_name", F.lit(" v"), F.col("schema_version").cast("string")))).otherwise(F.col("schema_name")))


def encode_envelope(header: dict, records: list) -> bytes:
    """An envelope's bytes; the same content gives the same bytes."""
    text = json.dumps({**header, "record_count": len(records), "records": records}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return gzip.compress(text.encode(), 6, mtime=0)


def decode_envelope(data: bytes, name: str, version: int) -> dict:
    """The envelope in bytes that may be compressed; another schema is an error."""
    envelope = json.loads(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    if (envelope.get("schema_name"), envelope.get("schema_version")) != (name, version):
        raise ValueError(f"unexpected envelope {envelope.get('schema_name')} v{envelope.get('schema_version')}")
    return envelope


def read_registry(spark: SparkSession, path: str, sha256: str | None = None) -> DataFrame:
    """A registry's CSV, all columns strings; with ``sha256`` the file's digest is checked before."""
    if sha256:
        found = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]
        if found != sha256:
            raise ValueError(f"digest of {path} is {found}")
    return spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST").csv(path)


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON; one that doesn't fit the schema is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Lines of JSON with columns in order of their names, nulls included."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def newest(spark: SparkSession, pattern: str) -> DataFrame:
    """The parquet export whose name is last among those that fit the pattern."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    names = sorted(str(f.getPath()) for f in (found or []))
    if not names:
        raise FileNotFoundError(pattern)
    return spark.read.parquet(names[-1])


def read_database(spark: SparkSession, url: str, name: str, key: str, parts: int, low: int, high: int, **options: str) -> DataFrame:
    """A table of a database over JDBC, read by ``parts`` tasks that each take a range of the whole-number ``key``; filters and columns are pushed down."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).option("partitionColumn", key)
    reader = reader.option("numPartitions", parts).option("lowerBound", low).option("upperBound", high)
    return reader.options(**options).load()


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    """A report as one JSON file, replaced whole: a reader sees the old one or the new one."""
    SharedPath(spark, path).write(json.dumps(report, sort_keys=True, ensure_ascii=False, default=str))


def chunks(items: Sequence, most: int) -> list[list]:
    """The items in order, at most so many to a request."""
    return [list(items[i : i + most]) for i in range(0, len(items), most)]


def query_fingerprint(**config: object) -> str:
    """A digest of what a query asks for, whatever the order of its settings."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str).encode()).hexdigest()


def fetched(fetch: Callable[[], dict], attempts: int, sleep: Callable[[float], None], jitter: Callable[[], float], retry_on: frozenset[int] = frozenset({429, 500, 502, 503, 504})) -> dict:
    """What ``fetch`` gives (status, and body or retry_after), tried again with growing delays while its status is one to retry; another bad status is an error at once."""
    for attempt in range(attempts):
        answer = fetch()
        if answer["status"] < 400:
            return answer
        if answer["status"] not in retry_on or attempt + 1 == attempts:
            raise RuntimeError(f"status {answer['status']} after {attempt + 1} attempts")
        sleep(retry_delay(attempt, answer.get("retry_after"), jitter()))
    raise ValueError("attempts must be positive")


def pack_terms(terms: Sequence[str], most: int, joiner: str = " OR ", tail: str = "") -> list[str]:
    """Terms packed in order into as few queries as greedy filling gives, none longer than ``most``."""
    out: list[str] = []
    for term in terms:
        if len(term) + len(tail) > most:
            raise ValueError(f"a term is too long: {term}")
        if out and len(out[-1]) + len(joiner) + len(term) + len(tail) <= most:
            out[-1] += joiner + term
        else:
            out.append(term)
    return [q + tail for q in out]


def retry_delay(attempt: int, told: float | None, jitter: float) -> float:
    """Seconds before the next attempt: what the server asks for, if more than doubling delays up to 30 s with jitter."""
    return max(told or 0.0, min(30.0, 2.0**attempt) + jitter)


@dataclass(frozen=True)
class Stream(InputPartition):
    """One cursor-paged listing, read by one task."""

    name: str


def pages(fetch: Callable[[str, str | None], dict], name: str, most: int) -> Iterator[dict]:
    """The records of a cursor-paged listing; a repeated cursor, or a next page beyond ``most``, is an error, so that no checkpoint moves past a gap."""
    cursor, seen = None, set()
    for _ in range(most):
        page = fetch(name, cursor)
        yield from page["records"]
        cursor = page.get("next")
        if not cursor:
            return
        if cursor in seen:
            raise ValueError(f"{name}: cursor {cursor} came again")
        seen.add(cursor)
    raise ValueError(f"{name}: more than {most} pages")


def found_posts(fetch: Callable[[str | None], dict], most: int) -> Iterator[dict]:
    """The pages of a search, newest first, all under the one cursor of its beginning; a page beyond ``most`` is an error, so that no checkpoint moves past posts not read."""
    token = None
    for _ in range(most):
        page = fetch(token)
        yield page
        token = page.get("next_token")
        if not token:
            return
    raise ValueError(f"more than {most} pages")


def looked_up_by_id(fetch: Callable[[list], list[dict]], ids: Sequence, most: int, key: str = "id") -> tuple[list[dict], list]:
    """The records of ids, asked for in batches and given in the order asked, and the ids that didn't come back; none at all is an error."""
    held = {record[key]: record for batch in chunks(list(dict.fromkeys(ids)), most) for record in fetch(batch)}
    if ids and not held:
        raise ValueError("nothing came back")
    wanted = list(dict.fromkeys(ids))
    return [held[i] for i in wanted if i in held], [i for i in wanted if i not in held]


def recent_trades(fetch: Callable[[list, int], list[dict]], markets: Sequence, floor: int, batch: int, page: int, most: int, at: str = "timestamp", key: str = "uid") -> tuple[list[dict], list[list]]:
    """The trades of markets from ``floor`` on, each once, oldest first, and the batches of which not all could be read.

    Pages of a batch come newest first; the scan of a batch ends with a short
    page, or with one that reaches behind the floor, or at ``most`` pages.
    """
    held, cut = {}, []
    for some in chunks(markets, batch):
        for number in range(most):
            rows = fetch(some, number * page)
            held.update({r[key]: r for r in rows if r[at] >= floor})
            if len(rows) < page or min(r[at] for r in rows) < floor:
                break
        else:
            cut.append(some)
    return sorted(held.values(), key=lambda r: (r[at], r[key])), cut


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Stream]:
        return [Stream(n) for n in self.options["listings"].split(",")]

    def read(self, partition: Stream) -> Iterator[tuple]:
        root = self.options["path"]

        def fetch(name: str, cursor: str | None) -> dict:
            with open(f"{root}/{name}-{cursor or 'first'}.json") as f:
                return json.load(f)

        for record in pages(fetch, partition.name, int(self.options.get("most", "1000"))):
            yield partition.name, json.dumps(record, sort_keys=True)


class PagedFeed(DataSource):
    """Cursor-paged listings that lie as files of pages in a folder; one task per listing.

    Options: path, listings (comma-separated), most (pages of a listing).
    """

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("listing", T.StringType()), T.StructField("record", T.StringType())])

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(dict(self.options))
