"""Near-duplicate classes by the Jaccard similarity of word shingles, joined through PartEnum signatures.

1. Sets: one pass gives each document's set size and 128-bit digest; documents with equal sets form a
   class, stood for by its smallest id, whatever its size.
2. A bounded sample shows which shingles are common (those of many distinct sets: they are left out of the
   signatures, which changes what is compared and never what is found) and which signatures are hot.
3. Signatures: a second pass gives (56 bits of the set's digest, signature) rows; rows with the same
   signature form a group, unless all are of one set; groups of the same sets are kept once. Rows of a
   hot signature, of which there are boundedly many, are dealt by salt at every step.
4. Checks: in each group the member that shares most signatures is compared with all others, which
   links most of a group; links make components. Only members of a group in different components
   remain; all pairs of these are compared, block with block, so that no row is made for a pair, and
   the blocks of a large group go to many tasks.
   A comparison is first of bucket counts, which bound the intersection from above, and only where
   these allow a link of text with text. A pair within one component needs no check, since components are what is asked for, so
   no link is lost and large groups of near copies cost a few times their size.
5. Components of the links; every document takes its class's component.

Texts of documents in some group are fetched once and written to the shared folder for the checks.

Words are told apart by 64-bit hashes and whole sets by two 64-bit sums of mixed hashes, under fixed seeds:
shingles and sets count as equal where these are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.llm.common import HOT_KEYS, join_hot, shuffles_removed, text_or_empty, written
from tallyquill.llm.components import components
from tallyquill.llm.held import let_go
from tallyquill.llm.partenum import signatures
from tallyquill.llm.shingles import set_digests, shingle_sets, slices

STAR_ROUNDS = 1
BLOCK, BLOCKS = 256, 16  # members of a group compared with as many others at a time, and blocks of either side in a task
HOT, SALTS = 40, 16  # sets of the sample that make a signature hot (at most SAMPLE * 200 / HOT are), tasks its rows go to
SET_BITS, LOW = 56, (1 << 12) - 1  # of a digest that tell sets of one group apart; last bits of a signature
SAMPLE, LEAST_COMMON, MOST_COMMON = 8_000, 8, 200_000  # documents looked at for common shingles, sets that make one common, shingles kept
BUCKETS = 256


def _parts(batches: Iterator[pa.RecordBatch]):
    """(ids, texts) of about a megabyte each; the columns are id and text."""
    let_go()
    for batch in batches:
        sizes = batch.column(1).to_pandas().str.len().tolist() if batch.num_rows else []
        for a, b in slices(sizes):
            part = batch.slice(a, b - a)
            yield part.column(0), part.column(1).to_pylist()


def _classes(width: int):
    def run(batches):
        for ids, texts in _parts(batches):
            starts, h = shingle_sets(texts, width)
            s1, s2 = set_digests(starts, h)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(starts), pa.int64()), pa.array(s1), pa.array(s2)], names=["doc_id", "n", "s1", "s2"])

    return run


def _shingles(width: int):
    """The shingles of each distinct set, distinct sets within a task once."""

    def run(batches):
        seen = set()
        for _, texts in _parts(batches):
            starts, h = shingle_sets(texts, width)
            for i, k in enumerate(zip(*(x.tolist() for x in set_digests(starts, h)), strict=True)):
                if k not in seen:
                    seen.add(k)
                    yield pa.RecordBatch.from_arrays([pa.array(h[starts[i] : starts[i + 1]].view(np.int64))], names=["h"])

    return run


def sampled(rows: DataFrame, n: int, sample: int) -> DataFrame:
    """About ``sample`` of n rows, by a hash of the id."""
    share = min(1.0, sample / max(1, n))
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("common")), F.lit(1_000_000)) < share * 1_000_000)


def common_shingles(some: DataFrame, width: int, least: int = LEAST_COMMON, most: int = MOST_COMMON) -> np.ndarray:
    """Hashes of the shingles held by at least ``least`` sets of a sample of documents, ascending."""
    found = some.mapInArrow(_shingles(width), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= least)
    with shuffles_removed(some.sparkSession):
        kept = found.orderBy(F.desc("k"), "h").limit(most).collect()
    return np.sort(np.array([r.h for r in kept], np.int64).view(np.uint64))


def _signed(width: int, percent: int, common: np.ndarray):
    """(key, signatures) of each set, sets within a task once. A key is SET_BITS of the set's digest; a
    signature has 48 bits, the last twelve of them never all 0 (hot ones are renamed to such)."""

    def run(batches):
        seen = set()
        for _, texts in _parts(batches):
            starts, h = shingle_sets(texts, width)
            s1, s2 = set_digests(starts, h)
            fresh = np.zeros(len(s1), bool)
            for i, k in enumerate(zip(s1.tolist(), s2.tolist(), strict=True)):
                if k not in seen:
                    seen.add(k)
                    fresh[i] = True
            owner, sig = signatures(starts, h, percent, common)
            mine = fresh[owner]
            owner, sig = owner[mine], sig[mine] >> np.uint64(16)
            sig[sig & np.uint64(LOW) == 0] |= np.uint64(1)
            order = np.argsort(owner, kind="stable")
            offsets = np.searchsorted(owner[order], np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(s1 & (1 << SET_BITS) - 1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig[order].view(np.int64)))], names=["key", "sigs"])

    return run


def _groups(rows: DataFrame, some: DataFrame, width: int, percent: int) -> DataFrame:
    """(g, hot, key, weight): the sets of every group of two and more, with the number of signatures that
    the group stands for."""
    common = common_shingles(some, width)

    def signed(of: DataFrame) -> DataFrame:
        return of.mapInArrow(_signed(width, percent, common), "key long, sigs array<long>").select("key", F.explode("sigs").alias("sig"))

    def renamed(salt: Column) -> Column:
        """A hot signature's name for one of its salts: 36 bits of a hash, then twelve of 0."""
        return F.shiftleft(F.shiftrightunsigned(F.xxhash64("sig", salt), 28), 12)

    hot = written(signed(some).groupBy("sig").agg(F.countDistinct("key").alias("k")).where(F.col("k") >= HOT).select("sig"), "hot")  # bounded by the sample, so broadcast
    names = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(renamed(F.col("salt")).alias("name"), F.col("sig").alias("of"))
    dealt = signed(rows).join(F.broadcast(hot.withColumn("is_hot", F.lit(True))), "sig", "left")
    dealt = dealt.select("key", F.when(F.col("is_hot"), renamed(F.pmod("key", F.lit(SALTS)).cast("int"))).otherwise(F.col("sig")).alias("sig"))
    group = Window.partitionBy("sig")
    # a group is named by its least and greatest set and a sum over all: copies in several tasks do not cancel
    seen = dealt.select("key", "sig", F.min("key").over(group).alias("lo"), F.max("key").over(group).alias("hi"), F.sum(F.shiftrightunsigned("key", SET_BITS - 31)).over(group).alias("total"))
    is_hot = F.col("sig").bitwiseAND(F.lit(LOW).cast("long")) == 0
    shared = seen.where(is_hot | (F.col("lo") != F.col("hi"))).join(F.broadcast(names), F.col("sig") == F.col("name"), "left")
    g = F.when(F.col("of").isNotNull(), F.xxhash64("of")).otherwise(F.xxhash64("lo", "hi", "total"))
    return shared.groupBy(g.alias("g"), F.col("of").isNotNull().alias("hot"), "key").agg(F.count(F.lit(1)).alias("weight"))


def _of_group(members: DataFrame, groups: DataFrame) -> DataFrame:
    """members joined with a table that has one row for each group (g, hot, ...); hot groups by salt."""
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = groups.withColumn("salt", F.explode(salts)).drop("hot")
    dealt = members.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).otherwise(0))
    return dealt.join(spread, ["g", "salt"]).drop("salt")


def _histograms(width: int):
    """How many elements of a set fall into each of BUCKETS buckets; empty where a count exceeds a byte."""

    def run(batches):
        for ids, texts in _parts(batches):
            starts, h = shingle_sets(texts, width)
            owner = np.repeat(np.arange(len(texts)), np.diff(starts))
            counts = np.bincount(owner * BUCKETS + (h >> np.uint64(56)).astype(np.int64), minlength=len(texts) * BUCKETS).reshape(-1, BUCKETS)
            packed = [c.astype(np.uint8).tobytes() if c.max() < 256 else b"" for c in counts]
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(starts), pa.int64()), pa.array(packed, pa.binary())], names=["id", "n", "hist"])

    return run


def _possible(percent: int):
    """Of (a, b, na, nb, ha, hb) rows, the (a, b) that may link: the intersection holds in each bucket
    no more elements than either set does."""

    def run(batches):
        for batch in batches:
            n = np.asarray(batch.column(2)) + np.asarray(batch.column(3))
            most = [int(np.minimum(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)).sum(dtype=np.int64)) if x and y else 1 << 60 for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            most = np.minimum(np.array(most, np.int64), n // 2)
            kept = batch.filter(pa.array(100 * most >= percent * (n - most)))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return run


def _compared(percent: int):
    """Of rows with two blocks of members, each member (id, n, label, hist): the pairs (a, b), one of each
    block, of different labels whose sizes and bucket counts allow a link. Pairs are compared where they
    stand, none but these leave the task."""

    def run(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                (ia, na, la, ha), (ib, nb, lb, hb) = _block(x.as_py()), _block(y.as_py())
                for i in range(len(ia)):
                    fit = (lb != la[i]) & (100 * np.minimum(nb, na[i]) >= percent * np.maximum(nb, na[i]))
                    at = np.flatnonzero(fit)
                    if not len(at):
                        continue
                    most = np.minimum(np.minimum(ha[i], hb[at]).sum(1, dtype=np.int64), (na[i] + nb[at]) // 2)
                    at = at[100 * most >= percent * (na[i] + nb[at] - most)]
                    out += [(min(ia[i], b), max(ia[i], b)) for b in ib[at].tolist()]
            out = sorted(set(out))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _block(members: list[dict]):
    ids, n, label = (np.array([m[k] for m in members], np.int64) for k in ("rep", "n", "label"))
    hist = np.full((len(members), BUCKETS), 255, np.int64)
    for i, m in enumerate(members):
        hist[i] = np.frombuffer(m["hist"], np.uint8) if m["hist"] else n[i]  # without counts no bound
    return ids, n, label, hist


def _linked(width: int, percent: int):
    """Of (a, b, ta, tb) rows, the (a, b) whose sets reach the threshold."""

    def run(batches):
        for batch in batches:
            sizes = [len(x.as_py()) + len(y.as_py()) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            for lo, hi in slices(sizes):
                part = batch.slice(lo, hi - lo)
                texts = part.column(2).to_pylist() + part.column(3).to_pylist()
                starts, h = shingle_sets(texts, width)
                n = part.num_rows
                good = []
                for i in range(n):
                    x, y = h[starts[i] : starts[i + 1]], h[starts[n + i] : starts[n + i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                kept = part.filter(pa.array(good, pa.bool_())) if n else part
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id reachable by links).

    Texts without words, null ones included, have no shingles, link with nothing and are their own
    component. Rows sharing an id are one document with several texts, linked where any of them is; a
    row with a null id links with nothing and has component null. An empty table gives an empty result.
    Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    sets = written(rows.mapInArrow(_classes(width), "doc_id long, n long, s1 long, s2 long"), "sets")
    some = sets.where("n > 0 and doc_id is not null")
    n_rows = sets.count()
    reps = written(some.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size")), "reps")
    class_of = written(join_hot(some, reps.drop("size"), reps.where(F.col("size") * HOT_KEYS > n_rows).drop("size"), ["n", "s1", "s2"], "doc_id").select("doc_id", "rep", "n").distinct(), "classes")

    known = rows.where("doc_id is not null")
    members = _groups(known, written(sampled(known, n_rows, SAMPLE), "sample"), width, percent)
    # should sets share a key, all of them are members
    keyed = reps.select(F.col("s1").bitwiseAND(F.lit((1 << SET_BITS) - 1)).alias("key"), "rep", "n")
    members = written(members.join(keyed, "key").groupBy("g", "rep", "n").agg(F.max("hot").alias("hot"), F.sum("weight").alias("weight")), "members")
    # who shares most signatures with most others: large groups count for more
    sizes = members.groupBy("g").agg(F.max("hot").alias("hot"), F.count(F.lit(1)).alias("k"))
    central = _of_group(members, sizes).groupBy("rep", "n").agg(F.sum(F.col("weight") * F.col("k").cast("double")).alias("central"))
    members = written(members.drop("weight").join(central, ["rep", "n"]), "groups")
    # the joins of texts and counts are sort-merge joins at every size: what they move grows with the input
    texts = written(rows.join(members.select(F.col("rep").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi").distinct(), "texts")
    hists = written(texts.mapInArrow(_histograms(width), "id long, n long, hist binary").distinct(), "histograms")

    def possible(pairs: DataFrame) -> DataFrame:
        for x in "ab":
            pairs = pairs.join(hists.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("hist").alias(f"h{x}")).hint("merge"), [x, f"n{x}"])
        return written(pairs.select("a", "b", "na", "nb", "ha", "hb").mapInArrow(_possible(percent), "a long, b long").distinct(), "near")

    def checked(near: DataFrame) -> DataFrame:
        a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
        b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
        return written(near.join(b.hint("merge"), "b").join(a.hint("merge"), "a").select("a", "b", "ta", "tb").mapInArrow(_linked(width, percent), "a long, b long").distinct(), "found")

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes allow a link, smaller id first, each once."""
        fit = pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        swap = F.col("a") > F.col("b")
        ends = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("na", "nb"), ("nb", "na"))]
        return fit.select(*ends).distinct()

    def in_blocks(labelled: DataFrame) -> DataFrame:
        """Pairs (a, b) of members of one group that may link: groups of any size are compared without a row
        for each pair, BLOCKS blocks with as many others in a task. Groups with the same members left are one."""
        names = labelled.groupBy("g").agg(F.max("hot").alias("hot"), F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.sum(F.shiftrightunsigned(F.xxhash64("rep", "n"), 33)).alias("total"))
        named = _of_group(labelled, names).withColumn("g", F.xxhash64("lo", "hi", "total"))
        labelled = written(named.groupBy("g", "rep", "n", "label").agg(F.max("hot").alias("hot")), "left")
        parts = labelled.groupBy("g").agg(F.max("hot").alias("hot"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"))
        dealt = _of_group(labelled, parts).join(hists.withColumnRenamed("id", "rep").hint("merge"), ["rep", "n"]).withColumn("block", F.pmod(F.xxhash64("rep", "g"), F.col("k")).cast("int"))
        blocks = dealt.groupBy("g", "k", "block").agg(F.collect_list(F.struct("rep", "n", "label", "hist")).alias("m"))
        some, last = F.floor(F.col("block") / BLOCKS).cast("int"), F.floor((F.col("k") - 1) / BLOCKS).cast("int")
        x = blocks.select("g", F.col("block").alias("i"), F.col("m").alias("x"), some.alias("p"), F.explode(F.sequence(some, last)).alias("q"))
        y = blocks.select("g", F.col("block").alias("j"), F.col("m").alias("y"), F.explode(F.sequence(F.lit(0), some)).alias("p"), some.alias("q"))
        twos = x.join(y.hint("merge"), ["g", "p", "q"]).where("i <= j")
        return twos.select("x", "y").mapInArrow(_compared(percent), "a long, b long").distinct()

    links = found = None
    done = rows.sparkSession.createDataFrame([], "a long, b long")
    centres = rows.sparkSession.createDataFrame([], "g long, a long, na long")
    n_members = members.count()
    labelled = members.withColumn("label", F.col("rep"))
    for step in range(STAR_ROUNDS + 1):
        # groups that still hold several components
        open_groups = labelled.groupBy("g").agg(F.max("hot").alias("hot"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("g", "hot")
        labelled = written(_of_group(labelled, open_groups), "open")
        kinds = labelled.groupBy("g", "label").agg(F.count(F.lit(1)).alias("k"))
        sums = kinds.groupBy("g").agg(F.sum("k").alias("s"), F.sum(F.col("k") * F.col("k").cast("double")).alias("q"))
        left = sums.agg(F.sum((F.col("s") * F.col("s").cast("double") - F.col("q")) / 2)).first()[0]
        if not left:
            break
        if left <= 2 * n_members or step == STAR_ROUNDS:
            found = checked(written(in_blocks(labelled).join(done, ["a", "b"], "left_anti"), "near"))
            links = found if links is None else links.unionByName(found)
            break
        b = labelled.withColumnsRenamed({"rep": "b", "n": "nb", "label": "lb"})
        fresh = labelled.select("g", "hot", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"), "central").join(centres, ["g", "a", "na"], "left_anti")
        top = fresh.groupBy("g").agg(F.max("hot").alias("hot"), F.max_by(F.struct("a", "na", "la"), F.struct("central", -F.col("a"), "na")).alias("c")).select("g", "hot", "c.*")
        top = written(top, "centres")
        centres = centres.unionByName(top.select("g", "a", "na"))
        pairs = _of_group(b.withColumn("rep", F.col("b")), top).where("la <> lb")
        pairs = written(apart(pairs), "pairs")
        # all texts of the two ids are compared, so such a pair is done whatever the sizes it came with
        near = possible(pairs)
        done = done.unionByName(near)
        found = checked(near)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        labelled = labelled.drop("label").join(labels, F.col("rep") == F.col("node"), "left").select("g", "hot", "rep", "n", "central", F.coalesce("label", "rep").alias("label"))

    # a document's rows with several texts tie their classes together; others reach their class's label directly
    several = class_of.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id")
    ties = class_of.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    labels = components(ties if links is None else links.unionByName(ties)) if not (links is None and ties.isEmpty()) else None
    if labels is None:
        component_of = class_of.groupBy("doc_id").agg(F.min("rep").alias("component_id"))
    else:
        named = class_of.join(labels, F.col("rep") == F.col("node"), "left").select("doc_id", F.coalesce("label", "rep").alias("component_id"))
        component_of = named.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(component_of.withColumnRenamed("doc_id", "id"), F.col("doc_id") == F.col("id"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
