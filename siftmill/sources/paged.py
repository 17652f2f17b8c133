"""Paged answers of an interface as a data source over a recording: one task follows one query from page to page.

Answers are recorded as a Parquet table in folders by a hash of the address, sorted by address, so that a page costs the read of one row
group wherever its link leads. A task holds one page at a time; a lost one starts its query again and finds the same pages."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siftmill.functions import text, url

PAGE = "agency string, page int, address string, status int, body string, error string"
ISSUER = "source_id string, publication string, region string, lead_words int"
#: Agencies and queries come from a registry that people keep; more than this is no registry.
MOST_STARTS = 10_000
#: Row groups of a recording are small: one is read for each page. Their size is looked at after each row, so small rows (refused pages) before large ones make none large.
ROW_GROUPS = {"parquet.block.size": 1 << 18, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


@dataclass(frozen=True)
class Recording:
    """``folder`` has ``bucket=n/`` for each hash that has an answer; all tasks can read it (a path or an address that Arrow knows)."""

    folder: str
    buckets: int = 64

    def bucket(self, address: Column) -> Column:
        return (F.crc32(address) % self.buckets).cast("int")

    def answer(self, address: str) -> tuple[int | None, str | None]:
        """Status and body; nulls if none is recorded."""
        return Shelf(self).answer(address)


class Shelf:
    """A recording as one task reads it: the footers of a folder are read once, then each answer costs one row group."""

    def __init__(self, recording: Recording):
        from pyarrow import fs

        self.recording, self.groups = recording, {}
        self.store, self.path = fs.FileSystem.from_uri(recording.folder)

    def opened(self, bucket: int) -> list[tuple]:
        """Least and greatest address, file and number of each row group of a folder."""
        from pyarrow import fs, parquet

        if bucket not in self.groups:
            files = self.store.get_file_info(fs.FileSelector(f"{self.path}/bucket={bucket}", allow_not_found=True))
            self.groups[bucket] = own = []
            for path in sorted(f.path for f in files if f.is_file and not f.base_name.startswith(("_", "."))):
                file = parquet.ParquetFile(self.store.open_input_file(path))
                at = file.schema_arrow.get_field_index("address")
                for i in range(file.num_row_groups):
                    s = file.metadata.row_group(i).column(at).statistics
                    own.append((s.min, s.max, file, i) if s is not None and s.has_min_max else (None, None, file, i))
        return self.groups[bucket]

    def answer(self, address: str) -> tuple[int | None, str | None]:
        for low, high, file, i in self.opened(zlib.crc32(address.encode()) % self.recording.buckets):
            if low is None or low <= address <= high:
                found = file.read_row_group(i, columns=["address", "status", "body"], use_threads=False)
                at = found["address"].to_pylist()
                if address in at:
                    row = found.slice(at.index(address), 1).to_pylist()[0]
                    return row["status"], row["body"]
        return None, None


def record(answers: DataFrame, recording: Recording) -> Recording:
    """Writes ``address, status, body``; of several answers of one address the least (status, then body) is kept."""
    one = answers.where("address IS NOT NULL").groupBy("address").agg(F.min(F.struct("status", "body")).alias("a")).select("address", F.col("a.status").cast("int").alias("status"), F.col("a.body").alias("body"))
    rows = one.withColumn("bucket", recording.bucket(F.col("address")))
    rows.repartition(recording.buckets, "bucket").sortWithinPartitions("bucket", "address").write.partitionBy("bucket").options(**ROW_GROUPS).parquet(recording.folder)
    return recording


@dataclass
class Start(InputPartition):
    agency: str
    address: str


def next_page(status: int | None, body: str | None, address: str) -> tuple[bool, str | None, str | None]:
    """Whether an answer is a page, the address after it, and its error. A page whose link is bad is a page still."""
    if status is None:
        return False, None, "no answer recorded"
    if status != 200:
        return False, None, f"HTTP {status}"
    try:
        page = json.loads(body or "")
    except ValueError:
        return False, None, "not JSON"
    if not isinstance(page, dict):
        return False, None, "not an object"
    if not isinstance(page.get("results") or [], list):
        return False, None, "results are no list"
    link = page.get("next_page_url")
    if not isinstance(link, str) or not link:
        return True, None, None
    onward = urljoin(address, link)
    if urlsplit(onward)[:2] != urlsplit(address)[:2]:
        return True, None, "next page elsewhere"
    return True, onward, None


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.starts = [Start(*s) for s in json.loads(options["starts"])]
        self.recording = Recording(options["recording"], int(options["buckets"]))
        self.most = int(options["pages"])

    def partitions(self) -> list[InputPartition]:
        return self.starts

    def read(self, start: Start | None) -> Iterator[tuple]:
        shelf = Shelf(self.recording)
        at, page = start.address if start else None, 0  # without queries there is one task, with nothing to start from
        while at:
            if page == self.most:
                yield start.agency, page, at, None, None, f"more than {self.most} pages"
                return
            status, body = shelf.answer(at)
            whole, onward, error = next_page(status, body, at)
            yield start.agency, page, at, status, body if whole else None, error
            at, page = onward, page + 1


class PagedAnswers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_answers"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


def bounded(df: DataFrame, what: str) -> list[Row]:
    """The rows of a table that people keep; an error if it is too large for one."""
    rows = df.limit(MOST_STARTS + 1).collect()
    if len(rows) > MOST_STARTS:
        raise ValueError(f"more than {MOST_STARTS} {what}")
    return rows


def agencies(sources: DataFrame, hosts: str, parameter: str = "conditions[agencies][]", order: str = "position") -> DataFrame:
    """``slug`` and ``ISSUER`` of each value of a repeated parameter in the addresses of enabled sources on ``hosts``; of several sources
    with one slug the first by ``order``, then by id. An address that can't be decoded names none."""
    own = sources.where(F.coalesce("enabled", F.lit(True)) & url.host(F.col("url")).rlike(hosts))
    each = own.select(order, "id", "publication", "region", "lead_words", F.explode(url.query_params(F.col("url"))).alias("p"))
    name, value = (F.try_url_decode(F.regexp_extract("p", r, 1)) for r in ("^([^=]*)", "^[^=]*=(.*)$"))
    named = each.where(name == parameter).withColumn("slug", value).where("slug <> ''")
    first = named.groupBy("slug").agg(F.min(F.struct(order, "id", "publication", "region", "lead_words")).alias("f"))
    return first.select("slug", F.col("f.id").alias("source_id"), "f.publication", "f.region", "f.lead_words")


def query_address(base: str, slug: Column, first: Column, last: Column, fields: tuple[str, ...] = ("title", "abstract", "html_url", "publication_date", "agencies", "document_number", "type"), per_page: int = 100) -> Column:
    """The address of an agency's rules of the days ``first`` to ``last``, oldest first."""
    part = lambda n, v: F.concat(F.url_encode(F.lit(n)), F.lit("="), F.url_encode(v))
    told = [("per_page", F.lit(str(per_page))), ("order", F.lit("oldest")), ("conditions[agencies][]", slug), ("conditions[type][]", F.lit("RULE"))]
    told += [("conditions[publication_date][gte]", F.date_format(first, "yyyy-MM-dd")), ("conditions[publication_date][lte]", F.date_format(last, "yyyy-MM-dd")), *(("fields[]", F.lit(f)) for f in fields)]
    return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *[part(n, v) for n, v in told]))


def answers(spark: SparkSession, starts: DataFrame, recording: Recording, pages: int = 20) -> DataFrame:
    """``PAGE`` rows of all queries (``starts``: agency, address): a row for each page, ``body`` null where there is none, and ``error``
    where a query ends before its last page."""
    own = bounded(starts.select("agency", "address").distinct(), "queries")
    spark.dataSource.register(PagedAnswers)
    options = {"starts": json.dumps(sorted(map(tuple, own))), "recording": recording.folder, "buckets": str(recording.buckets), "pages": str(pages)}
    return spark.read.format("paged_answers").options(**options).load()


def rule_rows(pages: DataFrame, known: DataFrame, slug: Column, start: Column, until: Column, hosts: str, lead_words: int = 60) -> DataFrame:
    """Every entry of the pages: ``agency, page, document_number, url, url_normalised, candidate_id, headline, lead, day`` with the issuer's
    ``source_id, publication, region`` and ``found_in``, and ``skipped`` (``invalid``, ``not_rule`` or ``out_of_window``; null: a candidate).

    ``known``: ``agencies``. The issuer is the first listed agency that is known, else the one asked for (``slug``, of a page's row). Days lie
    in ``[start, until)``. Fields of other types than expected count as absent, so one bad entry spoils no page."""
    issuers = {r["slug"]: {k: r[k] for k in ("source_id", "publication", "region", "lead_words")} for r in bounded(known, "agencies")}
    by_slug = F.from_json(F.lit(json.dumps(issuers)), f"map<string, struct<{ISSUER}>>")
    got = lambda v, p, t="string": F.try_variant_get(v, p, t)
    each = pages.where("body IS NOT NULL").select("agency", "page", slug.alias("_slug"), F.explode(got(F.try_parse_json("body"), "$.results", "array<variant>")).alias("_r"))
    r, by = F.col("_r"), F.col("_by")  # the issuer's own number of words cuts the lead
    listed = F.transform(F.coalesce(got(r, "$.agencies", "array<variant>"), F.array().cast("array<variant>")), lambda a: F.try_variant_get(a, "$.slug", "string"))
    rows = each.select(
        "agency", "page", "_slug", got(r, "$.document_number").alias("document_number"), F.trim(got(r, "$.html_url")).alias("url"), text.collapse(F.coalesce(got(r, "$.title"), F.lit(""))).alias("headline"),
        F.coalesce(got(r, "$.abstract"), F.lit("")).alias("_told"), got(r, "$.type").alias("_type"), F.try_to_date(F.trim(got(r, "$.publication_date")), "yyyy-MM-dd").alias("day"), listed.alias("_listed"), by_slug.alias("_map"),
    )
    issuer = F.coalesce(F.get(F.filter(F.transform("_listed", lambda s: F.try_element_at("_map", s)), lambda i: i.isNotNull()), 0), F.try_element_at("_map", F.col("_slug")))
    fits = F.col("url").rlike("^https://") & url.host(F.col("url")).rlike(hosts) & (F.col("headline") != "") & F.col("day").isNotNull()
    skipped = F.when(~F.coalesce(fits, F.lit(False)), "invalid").when(F.lower("_type") != "rule", "not_rule").when((F.col("day") < start) | (F.col("day") >= until), "out_of_window")
    out = rows.withColumns({"_by": issuer, "skipped": skipped})
    told = text.words(F.col("_told"))
    most = F.coalesce(by["lead_words"], F.lit(lead_words))
    lead = F.concat(F.array_join(F.slice(told, F.lit(1), most), " "), F.when(F.size(told) > most, "…").otherwise(""))
    return out.select("agency", "page", "document_number", "url", url.normalise(F.col("url")).alias("url_normalised"), url.candidate_id(F.col("url")).alias("candidate_id"), "headline", lead.alias("lead"), "day", by["source_id"].alias("source_id"), by["publication"].alias("publication"), by["region"].alias("region"), F.try_element_at("_map", F.col("_slug"))["source_id"].alias("found_in"), "skipped")


def report(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for each query: ``status`` (ok or failed), ``pages`` read, ``in_window``, ``invalid``, ``not_rule``, ``out_of_window``, ``api_count`` (as
    the first page says) and ``error``. What was read before a failure counts."""
    first = F.try_variant_get(F.try_parse_json(F.when(F.col("page") == 0, F.col("body"))), "$.count", "long")
    read = pages.groupBy("agency").agg(F.count("body").alias("pages"), F.max(first).alias("api_count"), F.max("error").alias("error"))
    kinds = {"in_window": F.col("skipped").isNull(), **{k: F.col("skipped") == k for k in ("invalid", "not_rule", "out_of_window")}}
    counts = rows.groupBy("agency").agg(*[F.count_if(c).alias(k) for k, c in kinds.items()])
    return read.join(counts, "agency", "left").select("agency", F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), "pages", "api_count", *[F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in kinds], "error")


def record_problem(address: Column, body: Column, expected: Column) -> Column:
    """Why a document's own record does not bear out its address, the first reason counting; null if it does: ``no_object``,
    ``no_document`` (its html_url is no document's), ``other_document``, ``other_number``, ``no_date``, ``other_date`` (not ``expected``, a date)."""
    v = F.try_parse_json(body)
    field = lambda n: F.try_variant_get(v, f"$.{n}", "string")
    asked, told = url.government_document(address), url.government_document(F.trim(field("html_url")))
    number, day = F.lower(F.substring_index(asked, "/", -1)), F.try_to_date(F.trim(field("publication_date")), "yyyy-MM-dd")
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return F.when(~is_object, "no_object").when(told.isNull(), "no_document").when(~F.coalesce(F.lower(told) == F.lower(asked), F.lit(False)), "other_document").when(F.lower(field("document_number")) != number, "other_number").when(day.isNull(), "no_date").when(~day.eqNullSafe(expected), "other_date")
