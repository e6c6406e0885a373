"""Lines that many documents share, by levelled sorted runs of line hashes. DataFrame functions only.

A line's key is the line without blanks and U+0009..U+000D at both ends, A-Z
lower-cased, known by 128 bits of hash; the empty key is never repeated. Documents come in batches. A run is a table
(key, documents that hold it, largest id), bucketed and sorted by key, so that runs
are joined without a shuffle of theirs. Each new batch is reduced to one row for each
key, merge-anti-joined with the runs (a key that a run has already settled, in
enough documents and with an id as large, adds nothing) and what is left is written as
a run of its own. `fanout` runs of a level are compacted into one of the next, so a
key is rewritten once per level and a batch meets few runs.

`without_repeated_lines` feeds a table to the runs in batches of falling ids, then drops
every line whose key is long enough and in enough documents, but for the largest id
that holds it. A text goes through one shuffle, beside the positions it loses.

Nulls: a null text is one empty line. Rows without an id keep all their lines and count
for no document. Rows that repeat an id are one document, each with a text of its own.
An empty table gives none. A text of any length is one row; its dropped positions are
one list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import own_shuffle, quoted, scratch_folder, written

LEAST_CHARS = 20
LEAST_DOCS = 3
BATCHES, FANOUT = 4, 3
KEY = ["h1", "h2"]
RUN = "h1 long, h2 long, docs long, last long"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WHITE = " \t\x0b\f\r"
# tried at the start of a run of blanks only, so that long runs stay cheap
_OUTER = r"^[ \t\x0B\f\r]++|(?<![ \t\x0B\f\r])[ \t\x0B\f\r]++$"


def folded(text: Column) -> Column:
    """A-Z in lower case; lower() does just that in ASCII, replace() is many times faster than translate()."""
    rest = text
    for upper, lower in zip(_UPPER, _LOWER, strict=True):
        rest = F.replace(rest, F.lit(upper), F.lit(lower))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(rest)


def stripped(line: Column) -> Column:
    """Without the blanks at both ends; most lines have none and are left as they are."""
    outer = [test(line, F.lit(c)) for c in _WHITE for test in (F.startswith, F.endswith)]
    return F.when(reduce(Column.__or__, outer), F.regexp_replace(line, _OUTER, "")).otherwise(line)


def line_hashes(value: Column) -> list[Column]:
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("line"), value).alias("h2")]


class LineRuns:
    """Levels of sorted runs (h1, h2, docs, last); a document must come in one batch only."""

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fanout: int = FANOUT):
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}  # of the runs by table name

    def add(self, lines: DataFrame) -> None:
        """A batch of (doc_id, h1, h2)."""
        fresh = lines.distinct().groupBy(KEY).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        for run in self._runs():
            done = self.spark.table(run).filter(F.col("docs") >= self.least_docs).select(*KEY, F.col("last").alias("newest"))
            at = (fresh["h1"] == done["h1"]) & (fresh["h2"] == done["h2"]) & (done["newest"] >= fresh["last"])
            fresh = fresh.join(done, at, "left_anti")
        self._place(fresh, 0)

    def repeated(self) -> DataFrame:
        """(h1, h2, last) of the keys in at least `least_docs` documents."""
        return self._merged(self._runs()).filter(F.col("docs") >= self.least_docs).select(*KEY, "last")

    def close(self) -> None:
        """Forget the tables' names; their files lie in the scratch folder."""
        for run in self.paths:
            self.spark.sql(f"drop table if exists {run}")

    def _runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def _merged(self, runs: list[str]) -> DataFrame:
        # from the files: Spark 4.1 takes a union of bucketed tables for partitioned by key, but appends their buckets
        rows = self.spark.read.schema(RUN).parquet(*[self.paths[r] for r in runs])
        return rows.groupBy(KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def _place(self, rows: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(self._sorted(rows))
        if len(self.levels[level]) == self.fanout:
            merged, self.levels[level] = self._merged(self.levels[level]), []
            self._place(merged, level + 1)

    def _sorted(self, rows: DataFrame) -> str:
        path = scratch_folder(self.spark, "run")
        name = path.rpartition("/")[2].replace("-", "_")
        writer = rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name


def _cuts(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut the documents into about equal batches."""
    shares = [i / batches for i in range(1, batches)]
    found = docs.agg(F.percentile_approx("doc_id", shares)).first()[0] if shares else None
    return sorted(set(found or []))


def _kept(parts: Column, gone: Column) -> Column:
    """The stretches between the positions gone (in order), joined again; linear in both."""

    def stretches(s: Column) -> Column:
        def stretch(i: Column) -> Column:
            first = F.when(i == 0, 0).otherwise(F.get(s["gone"], i - 1) + 1)
            count = F.coalesce(F.get(s["gone"], i), F.size(s["parts"])) - first
            return F.when(count > 0, F.array_join(F.slice(s["parts"], first + 1, count), "\n"))

        found = F.transform(F.sequence(F.lit(0), F.size(s["gone"])), stretch)
        return F.array_join(F.filter(found, lambda x: x.isNotNull()), "\n")

    # bound as one element, so that the text is split once and not for each stretch
    return F.transform(F.array(F.struct(parts.alias("parts"), gone.alias("gone"))), stretches)[0]


def without_repeated_lines(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """The columns of `docs` with n_lines, n_dropped and kept_text (taking the place of columns so named)."""
    marks = {"_tag1": F.xxhash64("text"), "_tag2": F.hash("text")}  # tell rows of one id apart
    texts = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), "text")
    cuts = _cuts(texts, batches)
    batch = sum((F.when(F.col("doc_id") <= c, 1).otherwise(0) for c in cuts), F.lit(0))
    lines = (
        texts.withColumns(marks)
        .select("doc_id", "_tag1", "_tag2", F.posexplode(F.split(folded(F.col("text")), "\n")).alias("pos", "line"))
        .select("doc_id", "_tag1", "_tag2", "pos", stripped(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= max(least_chars, 1))
        .select("doc_id", "_tag1", "_tag2", "pos", *line_hashes(F.col("key")), batch.alias("batch"))
    )
    lines = written(lines, "lines", "batch")

    runs = LineRuns(docs.sparkSession, least_docs, fanout)
    for i in range(len(cuts) + 1):
        runs.add(lines.filter(F.col("batch") == i).select("doc_id", *KEY))
    repeated = written(runs.repeated(), "repeated")
    runs.close()

    gone = lines.join(repeated, KEY).filter("doc_id <> last").groupBy("doc_id", "_tag1", "_tag2")
    gone = written(gone.agg(F.sort_array(F.collect_set("pos")).alias("_gone")), "gone")
    gone = gone.withColumnRenamed("doc_id", "_doc")

    new = ["n_lines", "n_dropped", "kept_text"]
    carried = [F.col(quoted(c)) for c in docs.columns if c not in new]
    rows = docs.select(*carried, F.col("doc_id").cast("long").alias("_doc")).withColumns(marks)
    text = F.coalesce("text", F.lit(""))
    parts = F.split(text, "\n")
    joined = rows.join(own_shuffle(gone, "_doc", "_tag1", "_tag2"), ["_doc", "_tag1", "_tag2"], "left")
    return joined.select(
        *carried,
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_gone").isNull(), text).otherwise(_kept(parts, F.col("_gone"))).alias("kept_text"),
    )
