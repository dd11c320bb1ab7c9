"""A cursor-paged service as a Spark data source, behind a client that can be swapped.

``fetch(filter, cursor, per_page)`` returns ``{"results": [...], "meta": {"next_cursor", "count"}}``.
Topics are split into batches, one partition each; a partition follows its cursor until a page is
empty. The stream form's offset is the cursor, committed with the data.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import sha1

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, In, InputPartition, LessThanOrEqual, SimpleDataSourceStreamReader

TOPICS_PER_BATCH, TOPICS_PER_COUNT = 10, 40
Fetch = Callable[[str, str, int], dict]


def batches(topics: list[str], size: int = TOPICS_PER_BATCH) -> list[list[str]]:
    return [topics[k : k + size] for k in range(0, len(topics), size)] or [[]]


# Fields that a sample of works asks for, and those of a whole work.
SAMPLE_FIELDS = ("id", "doi", "title", "publication_year", "type", "primary_topic", "abstract_inverted_index", "cited_by_count", "fwci", "institutions_distinct_count", "countries_distinct_count")
WORK_FIELDS = (
    "id", "doi", "title", "publication_year", "publication_date", "type", "primary_location", "open_access", "cited_by_count",
    "citation_normalized_percentile", "fwci", "primary_topic", "authorships", "institutions_distinct_count", "countries_distinct_count",
    "updated_date", "topics", "abstract_inverted_index", "referenced_works",
)


def pages(fetch: Fetch, filter_text: str, per_page: int = 200, fields: tuple[str, ...] = (), key: str = "results") -> Iterator[dict]:
    """All records, with ``fields`` alone if given, from the first cursor to the first empty page."""
    cursor = "*"
    while cursor:
        page = fetch(filter_text, cursor, per_page)
        results = page.get(key) or []
        if not results:
            return
        yield from ({f: r.get(f) for f in fields} for r in results) if fields else results
        cursor = (page.get("meta") or {}).get("next_cursor")


def count(fetch: Fetch, filters: list[str]) -> int:
    """Records that the filters match, by their counts alone."""
    return sum(int((fetch(f, "*", 1).get("meta") or {}).get("count") or 0) for f in filters)


def count_topics(fetch: Fetch, filter_of: Callable[[list[str]], str], topics: list[str]) -> int:
    """Records of all topics, asked for in parts that a request can hold; a work has one primary topic."""
    return count(fetch, [filter_of(part) for part in batches(topics, TOPICS_PER_COUNT)])


def grouped(fetch: Fetch, filter_text: str, per_page: int = 200) -> list[dict]:
    """A service's groups, ``key``, ``key_display_name`` and ``count``, commonest first."""
    return sorted(pages(fetch, filter_text, per_page, key="group_by"), key=lambda g: -int(g.get("count") or 0))


def topic_details(get: Callable[[str], dict], topics: list[str]) -> dict[str, dict]:
    """What is known of each topic; those that can't be had are left out."""
    out = {}
    for topic in topics:
        try:
            out[topic] = get(topic)
        except (OSError, RuntimeError, ValueError):
            continue
    return out


def download(spark, fetch: Fetch, filters: list[str], folder: str, wave: int = 8) -> int:
    """Records of all filters as JSON lines in ``folder/records``, a file set for each filter; how many filters were left to do.

    Filters that are done are noted in ``folder/done`` after their records are there. What a
    broken run left half done is written over by the next.
    """
    from pyspark.sql import functions as F

    try:
        done = {r["filter"] for r in spark.read.parquet(f"{folder}/done").collect()}
    except Exception as error:  # no run yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        done = set()
    left = [f for f in dict.fromkeys(filters) if f not in done]
    for k in range(0, len(left), wave):
        part = left[k : k + wave]
        spark.dataSource.register(paged_source(fetch, part, marked=True))
        marks = spark.createDataFrame([(f,) for f in part], "filter string").withColumn("batch", F.sha1("filter"))
        records = spark.read.format("paged_works").load().select(F.get_json_object("value", "$._batch").alias("batch"), F.get_json_object("value", "$.record").alias("value"))
        with_mode = records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
        with_mode.text(f"{folder}/records")
        marks.write.mode("append").parquet(f"{folder}/done")
    return len(left)


@dataclass
class KeyPool:
    """Keys in turn; rejected ones are out for good, exhausted ones until reset."""

    keys: list[str]
    out: dict[str, str] = field(default_factory=dict)
    at: int = 0

    def next(self) -> str | None:
        for _ in self.keys:
            key = self.keys[self.at % len(self.keys)]
            self.at += 1
            if key not in self.out:
                return key
        return None

    def mark(self, key: str, why: str) -> None:
        self.out[key] = why

    def reset(self) -> None:
        self.out = {k: w for k, w in self.out.items() if w == "rejected"}


def retried(call: Callable[[], dict], tries: int = 3, delay: float = 2.0, sleep: Callable[[float], None] | None = None) -> dict:
    """``call`` again after growing pauses; the last error is raised."""
    from time import sleep as pause

    for k in range(tries):
        try:
            return call()
        except OSError:
            if k == tries - 1:
                raise
            (sleep or pause)(delay * 2**k)
    raise ValueError("tries must be positive")


def spacing(query: str) -> float:
    """Least seconds between requests: services limit queries of many operators."""
    operators = sum(query.count(f" {w} ") for w in ("AND", "OR", "NOT"))
    return 1.05 if operators > 5 else 0.0


class _Batch(InputPartition):
    def __init__(self, filter_text: str):
        self.filter_text = filter_text


class _Reader(DataSourceReader):
    def __init__(self, fetch: Fetch, filters: list[str], per_page: int, marked: bool):
        self.fetch, self.filters, self.per_page, self.marked = fetch, filters, per_page, marked

    def partitions(self):
        return [_Batch(f) for f in self.filters]

    def read(self, partition):
        batch = sha1(partition.filter_text.encode()).hexdigest()
        for record in pages(self.fetch, partition.filter_text, self.per_page):
            yield (json.dumps({"_batch": batch, "record": record} if self.marked else record),)


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, fetch: Fetch, filter_text: str, per_page: int):
        self.fetch, self.filter_text, self.per_page = fetch, filter_text, per_page

    def initialOffset(self):
        return {"cursor": "*"}

    def _page(self, cursor):
        page = self.fetch(self.filter_text, cursor, self.per_page) if cursor else {}
        results = page.get("results") or []
        after = (page.get("meta") or {}).get("next_cursor") if results else cursor
        return [(json.dumps(r),) for r in results], after

    def read(self, start):
        rows, after = self._page(start["cursor"])
        return iter(rows), {"cursor": after}

    def readBetweenOffsets(self, start, end):
        return iter(self._page(start["cursor"])[0])


def paged_source(fetch: Fetch, filters: list[str], per_page: int = 200, marked: bool = False) -> type[DataSource]:
    """A data source class to register: ``spark.dataSource.register(...)``, format ``paged_works``.

    ``marked`` records have the filter's digest beside them.
    """

    class PagedWorks(DataSource):
        @classmethod
        def name(cls):
            return "paged_works"

        def schema(self):
            return "value string"

        def reader(self, schema):
            return _Reader(fetch, filters, per_page, marked)

        def simpleStreamReader(self, schema):
            return _Stream(fetch, filters[0], per_page)

    return PagedWorks


#: Columns of ``works`` beside the whole record, and which of them a service can filter by.
WORK_COLUMNS = "id string, doi string, title string, publication_date string, type string, topic_id string, value string"
LISTED, BOUNDED = {"topic_id": "primary_topic.id", "type": "type"}, {"publication_date": ("from_publication_date", "to_publication_date")}
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def work_row(record: dict) -> tuple:
    topic = (record.get("primary_topic") or {}).get("id")
    names = ("id", "doi", "title", "publication_date", "type")
    return (*(record.get(n) for n in names), topic and topic.rsplit("/", 1)[-1], json.dumps(record))


class _Works(DataSourceReader):
    """Works of a search; conditions on topics, types and dates go to the service, the rest stays with Spark."""

    def __init__(self, fetch: Fetch, search: str, form: str, per_page: int):
        self.fetch, self.search, self.form, self.per_page = fetch, search, form, per_page
        self.listed: dict[str, list[str]] = {}
        self.bounds: dict[str, str] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = list(f.value) if isinstance(f, In) else [f.value] if isinstance(f, EqualTo) else []
            texts = values and all(isinstance(v, str) and v and not set(v) & set(",|:") for v in values)
            if texts and column in LISTED and column not in self.listed:
                self.listed[column] = sorted(set(values))
            elif column in BOUNDED and isinstance(f, GreaterThanOrEqual | LessThanOrEqual) and isinstance(f.value, str):
                name = BOUNDED[column][isinstance(f, LessThanOrEqual)]
                if name in self.bounds:
                    yield f
                self.bounds.setdefault(name, f.value)
            else:
                yield f

    def partitions(self):
        """A partition for each batch of topics; counts ask for as many topics at once as a request holds."""
        size = TOPICS_PER_BATCH if self.form == "records" else TOPICS_PER_COUNT
        parts = [f"title_and_abstract.search:{self.search}"] if self.search else []
        parts += [f"{name}:{value}" for name, value in sorted(self.bounds.items())]
        parts += [f"{LISTED['type']}:{'|'.join(self.listed['type'])}"] if "type" in self.listed else []
        topics = [[f"{LISTED['topic_id']}:{'|'.join(t)}"] if t else [] for t in batches(self.listed.get("topic_id", []), size)]
        return [_Batch(",".join(parts + t)) for t in topics]

    def read(self, partition):
        if self.form == "count":
            yield (partition.filter_text, count(self.fetch, [partition.filter_text]))
        elif self.form == "groups":
            for group in grouped(self.fetch, partition.filter_text, self.per_page):
                yield (group.get("key"), group.get("key_display_name"), int(group.get("count") or 0))
        else:
            for record in pages(self.fetch, partition.filter_text, self.per_page):
                yield work_row(record)


def works_source(fetch: Fetch) -> type[DataSource]:
    """A data source class, format ``works``, options ``search``, ``form`` and ``per_page``.

    The form ``records`` (``WORK_COLUMNS``) follows cursors; ``count`` (filter, n) and ``groups``
    (key, name, n; of one partition's filter) read what the service counts. With the setting ``PUSHDOWN`` Spark
    hands conditions over: lists of topics and types, and inclusive bounds of dates, are asked of the service;
    values that a service's filter can't hold, other conditions and second ones on a column stay with Spark.
    """
    schemas = {"records": WORK_COLUMNS, "count": "filter string, n long", "groups": "key string, name string, n long"}

    class Works(DataSource):
        @classmethod
        def name(cls):
            return "works"

        def schema(self):
            return schemas[self.options.get("form", "records")]

        def reader(self, schema):
            given = self.options
            return _Works(fetch, given.get("search", ""), given.get("form", "records"), int(given.get("per_page", 200)))

    return Works


def read_works(spark, fetch: Fetch, **options):
    """A table of the service's works; conditions put on it reach the service."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(works_source(fetch))
    return spark.read.format("works").options(**options).load()
