"""Long exact spans shared between records."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavetide.llm.codes import BASE, BASE_2, Stretches, code_points, mix, text_pieces
from wavetide.session import durable

#: One number per hash function over tokens.
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)

#: Characters of a shared span at least.
SPAN = 256
#: Characters of a token (every character begins one, so that spans need no common word borders), and hash functions over tokens.
GRAM, HASHES = 32, 2
#: Contexts of one signature that are compared with one another; larger groups go by the hashes of their single spans.
GROUP = 64
#: A signature (or hash) with so many rows is hot; its rows are salted into so many parts.
HOT, SALT = 10_000, 64
#: Most signatures, and most records, that go out as a broadcast; more are met by a shuffle.
BROADCAST_SIGS, BROADCAST_DOCS = 500_000, 1_000_000
#: Bits of the table that is broadcast before such a shuffle, whatever the number of keys.
BITS = 1 << 27


def anchors(tokens: np.ndarray, size: int) -> np.ndarray:
    """For each run of ``size`` tokens the place of its least token (the leftmost of equals).

    These are the nodes of the Cartesian tree over the tokens: a token is the anchor of the runs that hold it and lie
    within its node's range, from behind the last smaller token to before the next one.
    """
    bits = int(len(tokens) + 1).bit_length()
    low = np.uint64((1 << bits) - 1)
    least = (tokens & ~low) | np.arange(len(tokens), dtype=np.uint64)
    w = 1
    while 2 * w <= size:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    if rest := size - w:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & low).astype(np.int64)


def compact_windows(codes: np.ndarray, offsets: np.ndarray, span: int, gram: int, hashes: int = HASHES) -> tuple[np.ndarray, ...]:
    """signature, text, anchor, first and last start, context: the compact windows of all spans of the texts.

    Under each hash function a span of ``span`` characters is known by its least token, its anchor, and the spans of one
    anchor, which have successive starts, make one compact window. The windows of all hash functions are joined as
    intervals: a joint window is a run of starts that have the same anchors throughout; its signature is made of all
    least tokens and the distances between them. Its context is the hash of the stretch that its spans cover together.
    Every span is in exactly one joint window, and equal spans have equal signatures and equal anchors within the span.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(codes) < span:
        return none
    stretches = Stretches(codes)
    tokens = stretches.windows(gram)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    n = len(codes) - span + 1
    start = np.flatnonzero(text[:n] == text[span - 1 :])
    if not len(start):
        return none
    found = [anchors(mix(tokens ^ np.uint64(SEEDS[k])), span - gram + 1)[start] for k in range(hashes)]
    new = np.concatenate([[True], np.diff(start) != 1])
    for at in found:
        new[1:] |= np.diff(at) != 0
    first = np.flatnonzero(new)
    s0, s1 = start[first], start[np.append(first[1:], len(start)) - 1]
    at = [x[first] for x in found]
    signature = np.zeros(len(first), np.uint64)
    for x in at:
        signature = mix(signature ^ tokens[x] ^ mix((x - at[0]).astype(np.uint64)))
    of = text[s0]
    return signature.view(np.int64), of, at[0] - offsets[of], s0 - offsets[of], s1 - offsets[of], stretches.of(s0, s1 + span).view(np.int64)


def shared_starts(contexts: list[str], lefts: list[int], lo: list[int], hi: list[int], span: int) -> list[list[tuple[int, int]]]:
    """Of contexts that meet at their anchors (``lefts``: characters before it), the ranges of starts (relative to the
    anchor) whose spans stand in the context of another record; lo and hi are the least and greatest record of each.

    Two contexts agree on one stretch around the anchor; the spans within it, and within both contexts, are shared.
    """
    n = len(contexts)
    left, right = max(lefts), max(len(c) - a for c, a in zip(contexts, lefts))
    grid = np.zeros((n, left + right), np.int64) - np.arange(1, n + 1)[:, None]  # outside a context nothing is equal
    for k, (c, a) in enumerate(zip(contexts, lefts)):
        grid[k, left - a : left - a + len(c)] = np.frombuffer(c.encode("utf-32-le", "surrogatepass"), np.uint32)
    out: list[list[tuple[int, int]]] = []
    for k in range(n):
        equal = grid == grid[k]
        before = np.where(equal[:, :left].all(1), left, np.argmin(equal[:, :left][:, ::-1], 1)) if left else np.zeros(n, np.int64)
        after = np.where(equal[:, left:].all(1), right, np.argmin(equal[:, left:], 1))
        ranges = {
            (int(-before[j]), int(after[j] - span))
            for j in range(n)
            if before[j] + after[j] >= span and (j != k or lo[k] != hi[k]) and not lo[j] == hi[j] == lo[k] == hi[k]
        }
        out.append(sorted(ranges))
    return out


def shared_spans(docs: DataFrame, span: int = SPAN, group: int = GROUP, broadcast: tuple[int, int] = (BROADCAST_SIGS, BROADCAST_DOCS)) -> DataFrame:
    """doc_id, span_start, span_end: the longest runs of characters of each text that lie in a stretch of ``span``
    characters which stands verbatim in the text of another doc_id (characters from 0, end exclusive).

    Compact windows (``compact_windows``) send one short row per about span / 5 characters instead of one per character:
    first only signature and record, combined before the shuffle, to find the signatures of several records; then the
    windows of those alone. Of them, windows with equal contexts in two records are shared throughout. Where a signature
    has several contexts, one text each is compared around the anchor; signatures with more than ``group`` contexts are
    settled span by span, by hashes of 128 bits, instead, so no task meets an unbounded group and no pair of records is
    formed. Only texts of records with such contexts are moved. Signatures of HOT rows and more are salted in joins.
    ``broadcast``: how many signatures and records may be broadcast; beyond that the same joins are shuffled.

    ``docs``: doc_id, text. Null, empty and shorter texts, and rows without doc_id, share nothing; repeated rows are one
    record (should one doc_id have several texts, runs of all of them are merged); further columns are dropped; repeats
    within one record alone are no spans; texts of any length are read whole.
    """
    gram = min(GRAM, span // 2)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null").filter(F.length("text") >= span)
    docs = docs.withColumn("part", F.hash("text"))  # tells texts of one doc_id apart

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_pieces(whole):
                sig, text, anchor, s0, s1, context = compact_windows(*code_points(batch.column("text")), span, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig), *(batch.column(c).take(pa.array(text)) for c in ("doc_id", "part")), pa.array(s0.astype(np.int32)), *(pa.array(x.astype(np.int32)) for x in (anchor - s0, s1 - s0)), pa.array(context)],
                    ["sig", "doc_id", "part", "s0", "before", "more", "ctx"],
                )

    windows = docs.mapInArrow(windows_of, "sig long, doc_id long, part int, s0 int, before int, more int, ctx long")
    ends = [F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")]

    in_several = durable(windows.groupBy("sig").agg(*ends, F.count(F.lit(1)).alias("n")).filter("lo <> hi").select("sig", (F.col("n") >= HOT).alias("hot")))
    rows = durable(salted_join(windows, in_several, ["sig"], "doc_id", broadcast[0]))

    # one row per signature and context, with the records that have it and one place where its text stands
    key = ["sig", "ctx", "before", "more"]
    contexts = rows.groupBy(*key).agg(*ends, F.max("hot").alias("hot"), F.min(F.struct("doc_id", "part", "s0")).alias("at"))
    per_sig = contexts.groupBy("sig").agg(F.count(F.lit(1)).alias("n_ctx"))
    contexts = contexts.join(per_sig, "sig").filter("n_ctx > 1 or lo <> hi").select(*key, "hot", "lo", "hi", "n_ctx", "at.doc_id", "at.part", F.col("at.s0").alias("s0"))
    contexts = durable(contexts)
    start, end = (-F.col("before")).cast("int"), (F.col("more") - F.col("before")).cast("int")
    whole = contexts.filter("n_ctx = 1").select(*key, "hot", F.array(F.struct(start.alias("a"), end.alias("b"))).alias("ranges"))

    several = contexts.filter("n_ctx > 1")
    wanted = several.select("doc_id").distinct()
    few_docs = wanted.limit(broadcast[1] + 1).count() <= broadcast[1]
    held = docs.join(F.broadcast(wanted), "doc_id", "left_semi") if few_docs else maybe_in(docs, wanted, ["doc_id"]).join(wanted.hint("merge"), "doc_id")  # a semi-join would go below
    held = held.dropDuplicates(["doc_id", "part"])
    stretch = F.substring(F.col("text"), F.col("s0") + 1, F.col("more") + F.lit(span))
    texts = durable(several.join(held, ["doc_id", "part"]).select(*key, "hot", "lo", "hi", "n_ctx", stretch.alias("context")))
    few = texts.filter(F.col("n_ctx") <= group).groupBy("sig").agg(F.collect_list(F.struct("ctx", "before", "more", "hot", "lo", "hi", "context")).alias("members"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"sig": [], "ctx": [], "before": [], "more": [], "hot": [], "ranges": []}
            for sig, members in zip(batch.column("sig").to_pylist(), batch.column("members").to_pylist()):
                found = shared_starts([m["context"] for m in members], [m["before"] for m in members], [m["lo"] for m in members], [m["hi"] for m in members], span)
                for m, ranges in zip(members, found):
                    if ranges:
                        for c, v in zip(out, (sig, m["ctx"], m["before"], m["more"], m["hot"], [{"a": a, "b": b} for a, b in ranges])):
                            out[c].append(v)
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema([("sig", pa.int64()), ("ctx", pa.int64()), ("before", pa.int32()), ("more", pa.int32()), ("hot", pa.bool_()), ("ranges", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))]),
            )

    compared = few.mapInArrow(compare, "sig long, ctx long, before int, more int, hot boolean, ranges array<struct<a:int,b:int>>")

    def single_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in text_pieces(whole_batch, "context"):
                codes, offsets = code_points(batch.column("context"))
                hashes = [Stretches(codes, base).windows(span).view(np.int64) for base in (BASE, BASE_2)]
                n = np.maximum(np.diff(offsets) - span + 1, 0)
                row = np.repeat(np.arange(len(n)), n)
                start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                where = offsets[row] + start
                before = batch.column("before").to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(row)) for c in (*key, "hot", "lo", "hi")), pa.array((start - before).astype(np.int32)), *(pa.array(h[where]) for h in hashes)],
                    [*key, "hot", "lo", "hi", "start", "h1", "h2"],
                )

    singles = texts.filter(F.col("n_ctx") > group).drop("n_ctx").mapInArrow(
        single_spans, "sig long, ctx long, before int, more int, hot boolean, lo long, hi long, start int, h1 long, h2 long"
    )
    twice = singles.groupBy("h1", "h2").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n"))
    twice = durable(twice.filter("lo <> hi").select("h1", "h2", (F.col("n") >= HOT).alias("hot")))
    settled = (
        salted_join(singles.withColumnRenamed("hot", "hot_sig"), twice, ["h1", "h2"], "ctx", broadcast[0])
        .groupBy(*key)
        .agg(F.max("hot_sig").alias("hot"), F.collect_list(F.struct(F.col("start").alias("a"), F.col("start").alias("b"))).alias("ranges"))
    )
    ranges = whole.unionByName(compared).unionByName(settled)
    # rows know whether their signature is hot, so only hot ranges are copied to all parts
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int")
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))
    found = rows.withColumn("salt", F.when(F.col("hot"), part).otherwise(0)).drop("hot").join(ranges.withColumn("salt", F.explode(parts)).drop("hot"), [*key, "salt"])
    found = found.select("doc_id", "s0", "before", "more", F.explode("ranges").alias("r"))
    # a context holds the starts s0 .. s0 + more
    anchor = F.col("s0") + F.col("before")
    a = F.greatest(anchor + F.col("r.a"), F.col("s0"))
    b = F.least(anchor + F.col("r.b"), F.col("s0") + F.col("more"))
    spans = found.select("doc_id", a.alias("a"), (b + span).alias("b")).filter(F.col("b") - F.col("a") >= span)
    return merge_runs(spans.repartition("doc_id").distinct())  # both in one shuffle


def maybe_in(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``on`` does not stand in ``keys``; none of the others is lost.

    Each key sets one of BITS bits, by its hash; the words that hold a bit, BITS / 64 at most, are broadcast. With as many keys as
    bits about a third of the other rows still goes, with far more nothing does, and the join that follows is as it would be.
    """
    slot = F.pmod(F.xxhash64(*on), F.lit(BITS))
    word, bit = F.shiftright(slot, 6).alias("_word"), F.pmod(slot, F.lit(64)).cast("int")
    words = keys.select(word, F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b")).groupBy("_word").agg(F.bit_or("b").alias("_bits"))
    met = rows.withColumn("_word", word).join(F.broadcast(words), "_word")
    return met.filter(F.call_function("shiftright", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1).drop("_word", "_bits")


def salted_join(rows: DataFrame, keys: DataFrame, on: list[str], spread: str, most: int) -> DataFrame:
    """The ``rows`` whose ``on`` stands in ``keys`` (each once, with ``hot``), with ``hot``. Up to ``most`` keys are broadcast.
    Beyond, the hot ones, few as each has HOT rows at least, still are; rows of the others, but those that ``maybe_in`` leaves
    out, are met by a shuffle."""
    if keys.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(keys), on)
    rows = maybe_in(rows, keys, on)
    hot = keys.filter("hot")
    if hot.limit(most + 1).count() > most:  # then they are no outliers, but each row's part must be found
        both = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
        return rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int")).join(keys.withColumn("_salt", both).hint("merge"), [*on, "_salt"]).drop("_salt")
    marked = rows.join(F.broadcast(hot), on, "left").withColumn("_salt", F.when(F.col("hot"), F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int")).otherwise(0)).drop("hot")
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))
    return marked.join(keys.withColumn("_salt", F.explode(copies)).hint("merge"), [*on, "_salt"]).drop("_salt")


def merge_runs(spans: DataFrame) -> DataFrame:
    """doc_id, span_start, span_end of the runs that the overlapping or touching ranges [a, b) of each document make."""
    along = W.partitionBy("doc_id").orderBy("a", "b")
    before = F.max("b").over(along.rowsBetween(W.unboundedPreceding, -1))
    runs = spans.withColumn("new", F.when(before >= F.col("a"), 0).otherwise(1)).withColumn("run", F.sum("new").over(along.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "run").agg(F.min("a").alias("span_start"), F.max("b").alias("span_end")).drop("run")


def shared_share(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_chars, n_shared: how many characters of each record lie in shared spans."""
    per_doc = spans.groupBy("doc_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("n_shared"))
    own = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"))
    return own.join(per_doc, "doc_id", "left").select("doc_id", "n_chars", F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"))
