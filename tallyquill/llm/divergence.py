"""Divergence of the sources of each language, by SQL over shards of its terms.

1. Where texts are read, terms are counted by (lang, source, term), with the number of documents they occur in;
   a task's counts are let go in parts of bounded size, so that what moves follows the vocabulary, not the texts.
2. The counts are dealt by a hash of (lang, term) into shards. Each shard sums its counts and keeps the terms of
   enough documents by DuckDB SQL over the stream of its rows.
3. Spark adds up each group's and language's total and number of kept terms. Every shard gets a copy of these
   sums for its languages, by a join on the shard, and by SQL over its own terms makes the partial sums of every
   pair of sources and the best terms of every source.
4. Spark merges: partial sums are added by pair, terms and items ranked by windows, of which Spark keeps
   no more rows than the rank asks for before it shuffles.

No shard holds more than its terms' counts and a row for each group; DuckDB gets a fixed share of memory and
goes to the task's own temporary folder beyond that. A row of the pairs is there for each two sources
of a language, as in the result.
"""

from __future__ import annotations

import re
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.llm.common import text_or_empty, written

LEAST_DOCS, TOP = 30, 50
UNIT, PRIOR = 1_000_000_000, 5
HELD = 200_000  # counts that a task holds before it lets them go
PIECE = 1 << 18  # bytes of a text that are looked at together
MEMORY = "400MB"

_TERM, _BETWEEN = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")
COUNTS = "lang string, source string, term string, n long, docs long"


def pieces(text: bytes) -> Iterator[bytes]:
    """A text in parts of about PIECE bytes that end between terms."""
    at = 0
    while at < len(text):
        end = _BETWEEN.search(text, at + PIECE) if at + PIECE < len(text) else None
        to = end.start() if end else len(text)
        yield text[at:to]
        at = to


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) into counts, as COUNTS says."""
    groups: dict[tuple, dict[bytes, list[int]]] = defaultdict(dict)
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in groups.items():
            n, docs = zip(*terms.values(), strict=True) if terms else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms)).cast(pa.string()), pa.array([source] * len(terms)).cast(pa.string()), pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )
        groups.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            known = groups[batch.column(0)[i].as_py(), batch.column(1)[i].as_py()]
            held -= len(known)
            own: dict[bytes, int] = defaultdict(int)
            for part in pieces(batch.column(2)[i].as_py().encode().lower()):  # of bytes: A-Z alone
                for term in _TERM.findall(part):
                    own[term] += 1
            for term, k in own.items():
                seen = known.get(term)
                if seen is None:
                    known[term] = [k, 1]
                else:
                    seen[0] += k
                    seen[1] += 1
            held += len(known)
            if held > HELD:
                yield from out()
                held = 0
    yield from out()


def _duck(run, schema: dict[str, pa.DataType]):
    """run(connection, stream of the partition's rows) as a function of batches."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with tempfile.TemporaryDirectory() as spill, duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": spill, "preserve_insertion_order": False}) as con:
            kind = pa.schema(list(schema.items()))
            rows = pa.RecordBatchReader.from_batches(kind, (b.cast(kind) for b in batches if b.num_rows))
            yield from run(con, rows)

    return each


def _streamed(con, sql: str) -> Iterator[pa.RecordBatch]:
    yield from con.sql(sql).to_arrow_reader(10_000)


_S, _I = pa.string(), pa.int64()


def _kept(least: int):
    def run(con, rows: pa.RecordBatchReader) -> Iterator[pa.RecordBatch]:
        con.execute("CREATE TABLE c AS SELECT shard, lang, source, term, CAST(sum(n) AS BIGINT) AS n, sum(docs) AS docs FROM rows GROUP BY ALL")
        yield from _streamed(con, f"SELECT shard, lang, source, term, n FROM c SEMI JOIN (SELECT lang, term FROM c GROUP BY ALL HAVING sum(docs) >= {least}) k USING (lang, term)")

    return _duck(run, {"shard": pa.int32(), "lang": _S, "source": _S, "term": _S, "n": _I, "docs": _I})


def _p(n: str, total: str, terms: str) -> str:
    return f"1 + CAST({UNIT} * (CAST({n} AS HUGEINT) + {PRIOR}) // (CAST({total} AS HUGEINT) + {PRIOR} * {terms}) AS BIGINT)"


def _partial(top: int):
    """Rows of counts (term not null) and group sums (term null: total and number of terms) of shards into
    (lang, source, part, item, value): pairs' partial sums, one order of the two sources, and each source's best terms."""

    def run(con, rows: pa.RecordBatchReader) -> Iterator[pa.RecordBatch]:
        con.execute("CREATE TABLE r AS SELECT * FROM rows")
        # terms are numbered, so that the pairs' join is on numbers
        con.execute("CREATE TABLE k AS SELECT row_number() OVER () AS id, * FROM (SELECT shard, lang, term, sum(n) AS n FROM r WHERE term IS NOT NULL GROUP BY ALL)")
        con.execute("CREATE TABLE g AS SELECT row_number() OVER (ORDER BY source) AS s, shard, lang, source, n AS total, terms, sum(n) OVER (PARTITION BY shard, lang) AS lang_total FROM r WHERE term IS NULL")
        con.execute(f"""CREATE TABLE d AS SELECT k.id, g.s, coalesce(r.n, 0) AS n, {_p('coalesce(r.n, 0)', 'g.total', 'g.terms')} AS p, {_p('k.n', 'g.lang_total', 'g.terms')} AS q
            FROM k JOIN g USING (shard, lang) LEFT JOIN r ON r.shard = k.shard AND r.lang = k.lang AND r.term = k.term AND r.source = g.source""")
        con.execute("CREATE TABLE pairs AS SELECT a.s AS a, b.s AS b, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value FROM d a JOIN d b ON a.id = b.id AND a.s < b.s GROUP BY ALL")
        yield from _streamed(con, "SELECT x.lang, x.source, 'pair' AS part, y.source AS item, value FROM pairs JOIN g x ON x.s = a JOIN g y ON y.s = b")
        yield from _streamed(con, f"SELECT g.lang, g.source, 'term' AS part, term AS item, p - q AS value FROM d JOIN g USING (s) JOIN k USING (id) WHERE d.n > 0 AND p > q QUALIFY row_number() OVER (PARTITION BY s ORDER BY p - q DESC, term) <= {top}")

    return _duck(run, {"shard": pa.int32(), "lang": _S, "source": _S, "term": _S, "n": _I, "terms": _I})


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, shards: int | None = None) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language lies from each other one (part
    pair, all ranks) and which terms it uses more than the language does (part term, ranks to ``top``).

    A null text, lang or source counts as ''. Repeated rows count each for itself. A source without terms is
    compared all the same; a language without kept terms gives pairs of value 0. An empty table gives
    an empty result; other columns are ignored. shards defaults to the session's shuffle partitions.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), text_or_empty("text").alias("text"))
    shard = F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int").alias("shard")
    counts = rows.mapInArrow(_counts, COUNTS).select(shard, "lang", "source", "term", "n", "docs")
    kept = written(counts.repartitionById(shards, "shard").mapInArrow(_kept(least_docs), "shard int, lang string, source string, term string, n long"), "kept-terms")

    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    vocabulary = kept.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("one").alias("terms"))
    occurring = rows.select("lang", "source").distinct()
    groups = written(occurring.join(sums, ["lang", "source"], "left").join(vocabulary, "lang", "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("terms", F.lit(0)).alias("terms")), "groups")

    at = kept.select("shard", "lang").distinct()
    copies = groups.join(at, "lang").select("shard", "lang", "source", F.lit(None).cast("string").alias("term"), "n", "terms")
    dealt = kept.withColumn("terms", F.lit(0).cast("long")).unionByName(copies).repartitionById(shards, "shard")
    partial = written(dealt.mapInArrow(_partial(top), "lang string, source string, part string, item string, value long"), "partial")

    one = partial.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = groups.where("terms = 0").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source < item").withColumn("value", F.lit(0).cast("long"))
    one = one.unionByName(bare)
    pairs = one.unionByName(one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")).withColumn("part", F.lit("pair"))
    terms = partial.where("part = 'term'")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), allowMissingColumns=True)
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def divergence_sql(least_docs: int = LEAST_DOCS, top: int = TOP) -> str:
    """The same in DuckDB, every term of every group at once."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL HAVING sum(docs) >= {least_docs}),
v AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM k GROUP BY lang),
s AS MATERIALIZED (SELECT lang, source, coalesce(n, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(c.n) AS n FROM c SEMI JOIN k USING (lang, term) GROUP BY ALL) USING (lang, source)),
p AS MATERIALIZED (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, {_p('coalesce(c.n, 0)', 's.total', 'terms')} AS p, {_p('k.n', 'v.total', 'terms')} AS q
  FROM s JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM x QUALIFY part = 'pair' OR rank <= {top}"""
