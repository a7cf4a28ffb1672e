"""Removal of repeated passages by sorted suffixes (operator 10).

A passage is a string of ``LENGTH`` bytes that also starts elsewhere. Not all suffixes
are sorted, only those at anchors: of all ``GRAM``-byte strings inside a passage the one
with the least hash. Equal passages have their anchors at the same places, so a passage
can only repeat where the string at its anchor does.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, mixed, slices, small_batches, text_or_empty
from tallyloom.session import stage

LENGTH, GRAM = 200, 100
SPAN = LENGTH - GRAM  # a passage starts at most so many bytes before its anchor
WIDE = SPAN + LENGTH  # bytes around an anchor that its passages lie in
#: Anchors of one string up to which they are sorted in one task; more are counted passage by passage.
MOST_IN_BUCKET = 20_000
ROWS_PER_BLOCK = 8_000
#: Frames are broadcast up to these sizes and joined by a shuffle beyond.
MOST_BROADCAST_ROWS, MOST_BROADCAST_BYTES = 1_000_000, 64_000_000
CHUNK_BYTES = 200_000
#: Bytes of text that a task holds at a time.
SLICE_BYTES = 4_000_000
#: Bytes of text whose passages a task counts at a time.
COUNTED_BYTES = 1_000_000
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


# --- anchors ------------------------------------------------------------------------------


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes of any run of bytes of a buffer, equal for equal runs wherever they are."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        with np.errstate(over="ignore"):
            values = mixed(np.arange(256, dtype=np.uint64), 9)[data] * powers(INVERSE, n)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
            self.scale = powers(BASE, n + 1)

    def all_of(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            found = (self.sums[length:] - self.sums[: len(self.sums) - length]) * self.scale[: len(self.sums) - length]
        return mixed(found, 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[stop] - self.sums[start]) * self.scale[start], 1)


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    have = 1
    while 2 * have <= width:
        values, have = pick(values[:-have], values[have:]), 2 * have
    return pick(values[: len(values) - width + have], values[width - have :]) if have < width else values


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place, hash of the anchor's string, and hash of all around it that passages lie in, of every anchor of the texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    starts = np.cumsum([0, *map(len, texts)])
    if len(data) < LENGTH:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    rolling = Rolling(data)
    grams = rolling.all_of(GRAM)
    least = sliding(grams, SPAN + 1, np.minimum)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    inside = np.arange(len(least)) + LENGTH <= starts[owner[: len(least)] + 1]
    least = np.where(inside, least, 0).astype(np.uint64)
    edge = np.zeros(SPAN, np.uint64)
    chosen = np.flatnonzero((grams == sliding(np.concatenate([edge, least, edge]), SPAN + 1, np.maximum)) & (grams > 0))
    text = owner[chosen]
    low, high = np.maximum(starts[text], chosen - SPAN), np.minimum(starts[text + 1], chosen + LENGTH)
    around = mixed(rolling.of(low, high) ^ (chosen - low).astype(np.uint64), 4)
    return text, chosen - starts[text], grams[chosen], around


def in_chunks(texts: list[bytes]):
    """Runs of texts of about ``CHUNK_BYTES`` and the number of the first one, so that the arrays stay small."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK_BYTES:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def repeated_strings(texts: DataFrame) -> DataFrame:
    """``g, n, differ`` for every anchor string that occurs more than once: how often, and whether what is around it differs."""

    def hashes(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                found = [anchors(some)[2:] for _, some in in_chunks(bytes_of(batch))]
                g, c = (np.concatenate([f[i] for f in found]).view(np.int64) for i in (0, 1))
                yield pa.record_batch({"g": pa.array(g), "c": pa.array(c)})

    grouped = texts.mapInArrow(hashes, "g long, c long").groupBy("g")
    counted = grouped.agg(F.count("*").alias("n"), F.min("c").alias("least"), F.max("c").alias("most")).where("n > 1")
    return counted.select("g", "n", (F.col("least") != F.col("most")).alias("differ"))


def small_or_not(df: DataFrame, sized: str | None = None) -> DataFrame:
    """``df`` staged, with a broadcast hint if its rows, and the bytes in the column ``sized``, are few."""
    df = stage(df)
    size = F.coalesce(F.sum(F.length(sized)), F.lit(0)) if sized else F.lit(0)
    told = df.agg(F.count("*").alias("rows"), size.alias("bytes")).first()
    return F.broadcast(df) if told["rows"] <= MOST_BROADCAST_ROWS and told["bytes"] <= MOST_BROADCAST_BYTES else df


def places(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """``mark, places`` of the texts with repeated anchor strings: a text's hash, and its anchors as 64-bit numbers.

    A number is 4 * place + kind; kind 0: all around the anchor is the same wherever its
    string occurs, so it is repeated; 1: it differs; 2: it differs and there are too many
    for one task.
    """

    def found(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                data = bytes_of(batch)
                marks = np.array([xxhash.xxh3_128_digest(t) for t in data], object)
                for first, some in in_chunks(data):
                    text, place, g, _ = anchors(some)
                    if len(g):
                        yield pa.record_batch({"mark": pa.array(marks[first + text], pa.binary()), "place": pa.array(place), "g": pa.array(g.view(np.int64))})

    kind = F.when(~F.col("differ"), 0).when(F.col("n") <= MOST_IN_BUCKET, 1).otherwise(2)
    # Joined by a shuffle at every size: the repeated strings grow with the texts.
    rows = texts.mapInArrow(found, "mark binary, place long, g long").join(repeated.select("g", kind.alias("kind")), "g")
    # Copies of a text give the same numbers, so a text's set is no longer than the text.
    return rows.groupBy("mark").agg(F.collect_set(F.col("place") * 4 + F.col("kind")).alias("all"))


def packed_places(rows: DataFrame) -> DataFrame:
    def pack(batches):
        for batch in batches:
            yield pa.record_batch({"mark": batch.column("mark"), "places": pa.array([np.sort(np.array(a, "<i8")).tobytes() for a in batch.column("all").to_pylist()], pa.binary())})

    return rows.mapInArrow(pack, "mark binary, places binary")


def marked(texts: DataFrame, columns: str) -> DataFrame:
    """``texts`` (row identity columns and text) with ``mark``."""

    def mark(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                data = bytes_of(batch)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([xxhash.xxh3_128_digest(t) for t in data], pa.binary())], names=[*batch.schema.names, "mark"])

    return texts.mapInArrow(mark, f"{columns}, mark binary")


# --- sorted suffixes ------------------------------------------------------------------------


def around(data: bytes, at: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Place, bytes before it, and the bytes around each anchor of a text that passages lie in; equal ones once, with the first place."""
    found = {}
    for place in at.tolist():
        low = max(0, place - SPAN)
        found.setdefault((place - low, data[low : place + LENGTH]), place)
    return [(place, left, held) for (left, held), place in found.items()]


def inside_repeats(data: bytes, at: np.ndarray) -> np.ndarray:
    """The anchors of a text of which another one in the same text is surrounded alike."""
    keys = [(min(p, SPAN), data[max(0, p - SPAN) : p + LENGTH]) for p in at.tolist()]
    seen: dict = {}
    for key in keys:
        seen[key] = seen.get(key, 0) + 1
    return np.array([seen[k] > 1 for k in keys], bool)


def multikey_order(table: np.ndarray) -> np.ndarray:
    """The order of rows of bytes, by multikey quicksort with eight bytes as a character.

    Rows are parted by a character; only runs that are equal so far are parted by the next.
    """
    words = np.ascontiguousarray(table).view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    run = np.concatenate([[0], np.cumsum(words[order[1:], 0] != words[order[:-1], 0])]) if len(order) else order
    for i in range(1, words.shape[1]):
        tied = np.flatnonzero(np.bincount(run)[run] > 1)
        if not len(tied):
            break
        rows = order[tied]
        order[tied] = rows[np.lexsort((words[rows, i], run[tied]))]
        new = np.concatenate([[False], (run[1:] != run[:-1]) | (words[order[1:], i] != words[order[:-1], i])])
        run = np.cumsum(new)
    return order


def sorted_repeats(held: pd.DataFrame) -> pd.DataFrame:
    """``mark, start, stop`` of what is repeated around the anchors of some whole groups of equal anchor strings.

    The suffixes at the anchors are sorted; those that start a byte earlier are in the
    order of that byte and then of the ones before, so each further start takes one
    stable pass. Passages that are equal are neighbours in their order.
    """
    n = len(held)
    table = np.zeros((n, WIDE), np.uint8)
    left, size = held["left"].to_numpy(), held["held"].str.len().to_numpy()
    for i, (before, data) in enumerate(zip(left, held["held"])):
        table[i, SPAN - before : SPAN - before + len(data)] = np.frombuffer(data, np.uint8)
    right, twice = size - left, held["times"].to_numpy() > 1
    order = multikey_order(table[:, SPAN:])
    first, last = np.full(n, -1), np.full(n, -1)
    for back in range(SPAN + 1):
        at = SPAN - back
        if back:
            order = order[np.argsort(table[order, at], kind="stable")]
        rows = order[(left[order] >= back) & (right[order] >= LENGTH - back)]
        if not len(rows):
            continue
        same = (table[rows[1:], at : at + LENGTH] == table[rows[:-1], at : at + LENGTH]).all(axis=1)
        hit = twice[rows].copy()
        hit[1:] |= same
        hit[:-1] |= same
        hit = rows[hit]
        first[hit] = back
        last[hit] = np.where(last[hit] < 0, back, last[hit])
    known = first >= 0
    place = held["place"].to_numpy()
    return pd.DataFrame({"mark": held["mark"][known], "start": (place - first)[known], "stop": (place - last + LENGTH)[known]})


def suffixes(rows: DataFrame, kind: int) -> DataFrame:
    """``mark, place, left, held, times, lead`` for the anchors of one kind in rows of ``mark, text, places``."""

    def cut(batches):
        for whole in batches:
            for batch in slices(whole, "text", 4_000_000):
                out = []
                for mark, data, numbers in zip(batch.column("mark").to_pylist(), bytes_of(batch), batch.column("places").to_pylist()):
                    numbers = np.frombuffer(numbers, "<i8")
                    at = numbers[numbers % 4 == kind] // 4
                    if len(at):
                        repeats = set(at[inside_repeats(data, at)].tolist())
                        out += [(mark, p, left, held, 2 if p in repeats else 1, data[p : p + GRAM]) for p, left, held in around(data, at)]
                if out:
                    columns = list(zip(*out))
                    kinds = (pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["mark", "place", "left", "held", "times", "lead"])

    return rows.mapInArrow(cut, "mark binary, place long, left int, held binary, times int, lead binary")


def by_sorting(rows: DataFrame) -> DataFrame:
    """Repeats around anchors whose strings are few: sampled splitters deal the suffixes to buckets by their leading bytes.

    Suffixes with the same leading bytes are in one bucket, at most ``MOST_IN_BUCKET``; a
    task sorts a bucket's groups in blocks, and a block ends where a group does.
    """
    dealt = suffixes(rows, 1).repartitionByRange("lead").sortWithinPartitions("lead")

    def blocks(batches):
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            frame = batch.to_pandas()
            for start in range(0, len(frame), ROWS_PER_BLOCK):
                part = frame.iloc[start : start + ROWS_PER_BLOCK]
                if count >= ROWS_PER_BLOCK:
                    # Rows that go on with the last group belong to it.
                    last = held[-1]["lead"].iloc[-1]
                    on = int((part["lead"] == last).to_numpy().argmin()) if (part["lead"] != last).any() else len(part)
                    held.append(part.iloc[:on])
                    part = part.iloc[on:]
                    if len(part):
                        yield pa.RecordBatch.from_pandas(sorted_repeats(pd.concat(held, ignore_index=True)), SPANS, preserve_index=False)
                        held, count = [], 0
                if len(part):
                    held.append(part)
                    count += len(part)
        if held:
            yield pa.RecordBatch.from_pandas(sorted_repeats(pd.concat(held, ignore_index=True)), SPANS, preserve_index=False)

    return dealt.mapInArrow(blocks, "mark binary, start long, stop long")


SPANS = pa.schema([("mark", pa.binary()), ("start", pa.int64()), ("stop", pa.int64())])


def told_by_slice(texts: list[tuple[bytes, bytes, np.ndarray, int]]) -> pa.RecordBatch:
    """What some texts (mark, bytes, starts of passages in ascending order, how often it is there) tell of their passages, as rows of ``COUNTED``.

    Each different passage is one row, however often it occurs in them: with its place if
    only others can tell that it is repeated. Repeats known here are rows with a ``stop``.
    """
    sizes = np.array([len(own) for _, _, own, _ in texts], np.int64)
    digests = b"".join(b"".join([xxhash.xxh3_128_digest(data[i : i + LENGTH]) for i in own.tolist()]) for _, data, own, _ in texts)
    halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
    owner = np.repeat(np.arange(len(texts)), sizes)
    start = np.concatenate([np.zeros(0, np.int64), *(own for _, _, own, _ in texts)])
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
    group = np.cumsum(new) - 1
    often = np.bincount(group, np.array([times for *_, times in texts], np.int64)[owner[order]]) > 1
    first = order[new]
    known = np.zeros(len(order), bool)
    known[order] = often[group]
    # Known repeats of a text that touch are one run.
    at = np.flatnonzero(known)
    begins = np.ones(len(at), bool)
    begins[1:] = (owner[at[1:]] != owner[at[:-1]]) | (start[at[1:]] > start[at[:-1]] + LENGTH)
    ends = np.append(begins[1:], True)[: len(at)]
    marks = pa.array([mark for mark, *_ in texts], pa.binary())
    runs = marks.take(pa.array(owner[at[begins]]))
    passage = pa.array([digests[16 * i : 16 * i + 16] for i in first.tolist()], pa.binary())
    asked = pa.array(owner[first], mask=often)
    none = pa.nulls(len(first), pa.int64())
    return pa.record_batch({
        "passage": pa.concat_arrays([passage, runs]), "mark": pa.concat_arrays([marks.take(asked), runs]),
        "start": pa.concat_arrays([pa.array(start[first], mask=often), pa.array(start[at[begins]])]),
        "stop": pa.concat_arrays([none, pa.array(start[at[ends]] + LENGTH)]),
    })


COUNTED = "passage binary, mark binary, start long, stop long"


def by_counting(rows: DataFrame) -> DataFrame:
    """Repeats around anchors whose strings are too many for a task: every passage is counted by its bytes' hash, first within slices of texts.

    A slice sends a passage once, so the commonest one is no more rows than there are slices.
    """

    def passages(batches):
        for whole in batches:
            for batch in slices(whole, "text", COUNTED_BYTES):
                marks, held, times = batch.column("mark").to_pylist(), {}, Counter()
                for mark, data, numbers in zip(marks, bytes_of(batch), batch.column("places").to_pylist()):
                    times[mark] += 1
                    if times[mark] == 1:
                        numbers = np.frombuffer(numbers, "<i8")
                        # Every passage of the text once, however many anchors lie in it.
                        ranges = [np.arange(max(0, p - SPAN), min(p, len(data) - LENGTH) + 1) for p in (numbers[numbers % 4 == 2] // 4).tolist()]
                        if ranges:
                            held[mark] = (data, np.unique(np.concatenate(ranges)))
                if held:
                    yield told_by_slice([(mark, data, own, times[mark]) for mark, (data, own) in held.items()])

    told = rows.mapInArrow(passages, COUNTED)
    alike = Window.partitionBy("passage")
    told = told.withColumn("n", F.count(F.when(F.col("stop").isNull(), 1)).over(alike))
    found = told.where(F.col("mark").isNotNull() & (F.col("stop").isNotNull() | (F.col("n") > 1)))
    return found.select("mark", "start", F.coalesce("stop", F.col("start") + LENGTH).alias("stop"))


# --- removal --------------------------------------------------------------------------------


def joined_runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(r) for r in out]


def passages_in(data: bytes, numbers: np.ndarray, spans: np.ndarray) -> list[tuple[int, int]]:
    """The removed runs of a text: around anchors that are alike everywhere or twice in the text, and the spans found by sorting or counting."""
    at, kind = numbers // 4, numbers % 4
    differ = at[kind > 0]
    full = np.concatenate([at[kind == 0], differ[inside_repeats(data, differ)] if len(differ) else differ])
    known = [(max(0, p - SPAN), min(len(data), p + LENGTH)) for p in full.tolist()]
    return joined_runs([*(s for s in known if s[1] - s[0] >= LENGTH), *map(tuple, spans.tolist())])


def repeated_passages(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: the removed runs of bytes, and the bytes that stay.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else,
    in the same text or another; overlaps count. Rows with equal texts repeat each other.
    A null text counts as empty; ids may be null or repeated.
    """
    # Each pass holds texts in Spark, in Arrow and in Python; smaller batches keep that low.
    small_batches(df.sparkSession)
    texts = df.select(text_or_empty(text_column).alias("text"))
    repeated = stage(repeated_strings(texts))
    known = small_or_not(packed_places(places(texts, repeated)), "places")
    held = marked(texts, "text string").join(known, "mark")
    found = by_sorting(held)
    if not repeated.where((F.col("n") > MOST_IN_BUCKET) & F.col("differ")).isEmpty():
        found = found.unionByName(by_counting(held))
    spans = found.groupBy("mark").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    spans = stage(spans.select("mark", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops")))
    told = small_or_not(known.join(spans, "mark", "left"), "places")
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def remove(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                runs, kept, data = [], [], bytes_of(batch)
                for text, packed, starts, stops in zip(data, *(batch.column(c).to_pylist() for c in ("places", "starts", "stops"))):
                    spans = np.array([starts or [], stops or []], np.int64).T
                    found = passages_in(text, np.frombuffer(packed, "<i8"), spans) if packed else []
                    runs.append([{"start": a, "stop": b} for a, b in found])
                    ends = [0, *(x for r in found for x in r), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2])))
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id"), "n_bytes": pa.array([len(t) for t in data], pa.int64()),
                    "spans": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), "kept": pa.array(kept, pa.binary()),
                })

    whole = marked(rows, f"doc_id {kind}, text string").join(told, "mark", "left").select("doc_id", "text", "places", "starts", "stops")
    return whole.mapInArrow(remove, f"doc_id {kind}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def op10_suffix_sorted_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
