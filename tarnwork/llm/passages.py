"""Substring deduplication: automata of recurring passages locate every occurrence."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import groupby, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import batched, materialize, pick, release, table

c = F.col

#: A window's words, and the signs that part words.
WINDOW = 20
SPACE = b"\x20\t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

GRAM = 6  # words of the gram that stands for a window
HOT = 10_000  # places beyond which a gram's windows are dealt out one by one
GRAM_BITS, DOCUMENT_BITS, PARTS = 27, 24, 64  # sizes of the bit tables: 16 MB and 2 MB
SLICE, ROWS = 1 << 19, 1 << 14  # bytes of text, or rows, that are computed at once
BLOCK = 200_000  # recurring windows of a block of documents
AUTOMATON = 400_000  # words of the passages in one automaton

_ODD, _UNEVEN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _UNEVEN
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """64-bit hashes of words, by prefix sums over the bytes."""

    def __init__(self) -> None:
        self._of = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
        self._is_space = np.zeros(256, bool)
        self._is_space[list(SPACE)] = True
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            odd = int(_ODD)
            for name, base in (("_powers", odd), ("_inverse", pow(odd, -1, 1 << 64))):
                steps = np.full(max(n, SLICE), base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text number of every word of the texts that lie between ``offsets``."""
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        space = self._is_space[data]
        before, after = np.empty_like(space), np.empty_like(space)
        before[1:], after[:-1] = space[:-1], space[1:]
        starts = np.flatnonzero(~space & (before | edge[:-1]))
        ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        out, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            low = int(starts[at])
            to = max(at + 1, int(np.searchsorted(ends, low + SLICE, "right")))
            high = int(ends[to - 1])
            self._grow(high - low + 1)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(self._of[data[low:high]] * self._powers[: high - low], out=sums[1:])
            a, b = starts[at:to] - low, ends[at:to] - low
            out[at:to] = (sums[b] - sums[a]) * self._inverse[a] + (b - a).astype(np.uint64)
            at = to
        return mixed(out), np.searchsorted(offsets, starts, "right") - 1


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` words in a row."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for j in range(n):
        out = out * _UNEVEN + h[j : len(h) - n + 1 + j]
    return mixed(out)


def leftmost_least(g: np.ndarray, n: int) -> np.ndarray:
    """Place of the leftmost least of every ``n`` values in a row."""
    at, size = np.arange(len(g)), 1
    while size < n:
        by = min(size, n - size)
        left, right = at[:-by], at[by:]
        at = np.where(g[right] < g[left], right, left)
        size += by
    return at


class Windows:
    """All windows of some texts: text, place, hash, and the stretches of windows that stand on one gram."""

    def __init__(self, hasher: Hasher, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        words, text = hasher.words(data, offsets)
        n = len(words) - window + 1
        if n <= 0:
            self.text = self.place = self.first = self.size = np.zeros(0, np.int64)
            self.hash = self.gram = np.zeros(0, np.uint64)
            return
        valid = np.flatnonzero(text[:n] == text[window - 1 :])
        begins = np.searchsorted(text, np.arange(len(offsets)), "left")
        grams = rolled(words, gram)
        on = leftmost_least(grams, window - gram + 1)[valid]
        self.text, self.place, self.hash = text[valid], valid - begins[text[valid]], rolled(words, window)[valid]
        self.first = np.flatnonzero(np.diff(on, prepend=-1) != 0)  # of each stretch; another text has other places
        self.size = np.diff(self.first, append=len(valid))
        self.gram = mixed(grams[on[self.first]])


def _sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Whole rows of at most SLICE bytes of text, or one longer row: the rows, the bytes, the offsets of the texts."""
    for batch in batches:
        texts = batch.column(column).fill_null("")
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
            yield batch.slice(at, to - at), held[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, row, at, doc_id, text): place in the order, hash of the text, hash of both."""
    rows = pick(docs, doc_id="long", text="string").select(
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), F.xxhash64("text").alias("row"), "doc_id", "text"
    )
    return rows.withColumn("at", F.xxhash64("doc", "row"))


def bit_table(hashes: DataFrame, log2: int) -> np.ndarray:
    """A table of 2^log2 bits, set at the upper bits of every hash (one column); its size does not grow with the hashes.

    A hash that is not among them may be found set; whoever asks has to bear
    that.  The table is put together from PARTS parts, each by one task.
    """
    schema = pa.schema([("part", pa.int64()), ("bits", pa.binary())])
    size = (1 << log2) // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, np.zeros(size, bool)
        for batch in batches:
            places = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - log2)
            parts = places // np.uint64(size)
            for p in np.unique(parts).tolist():
                if p != part and part is not None:
                    yield _one(part, held, schema)
                    held[:] = False
                part = p
                held[(places[parts == p] % np.uint64(size)).astype(np.int64)] = True
        if part is not None:
            yield _one(part, held, schema)

    name = hashes.columns[0]
    of = F.shiftrightunsigned(name, 64 - 6).alias("part")
    dealt = hashes.select(name).withColumn("part", of).repartition("part").sortWithinPartitions("part").select(name)
    out = np.zeros((PARTS, size // 8), np.uint8)
    for r in dealt.mapInArrow(run, "part long, bits binary").collect():  # PARTS rows
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _one(part: int, held: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": [part], "bits": [np.packbits(held).tobytes()]}, schema=schema)


def _is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = (hashes.view(np.uint64) >> np.uint64(64 - 3 - (len(bits).bit_length() - 1))).astype(np.int64)
    return (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1


def _grams(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(gram, n): how many stretches of windows stand on each gram."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for _, data, offsets in _sliced(batches, "text"):
            found, n = np.unique(Windows(hasher, data, offsets, window, gram).gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(found)), pa.array(n.astype(np.int64))], schema=schema)
        release()

    return docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")


_ASK = "key long, doc long, row long, place long, size long, windows binary, from_doc long, from_row long, from_place long"
_HIT = "doc long, row long, place long, size long, from_doc long, from_row long, from_place long"


def _schema(text: str) -> pa.Schema:
    return pa.schema([(x.split()[0], {"long": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for x in text.split(", ")])


def _stretches(follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of every run; ``follows`` says which rows continue the one before."""
    first = np.flatnonzero(~follows)
    return first, np.diff(first, append=len(follows))


def _joined(columns: Sequence[np.ndarray], sizes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Neighbouring hits (doc, row, place, from_doc, from_row, from_place) as runs, with their sizes."""
    doc, row, place, from_doc, from_row, from_place = columns
    follows = np.zeros(len(doc), bool)
    follows[1:] = (
        (doc[1:] == doc[:-1]) & (row[1:] == row[:-1]) & (place[1:] == place[:-1] + sizes[:-1])
        & (from_doc[1:] == from_doc[:-1]) & (from_row[1:] == from_row[:-1]) & (from_place[1:] == from_place[:-1] + sizes[:-1])
    )
    first, _ = _stretches(follows)
    total = np.add.reduceat(sizes, first) if len(first) else sizes
    return [x[first] for x in columns], total


def _asked(docs: DataFrame, recurring, hot, window: int, gram: int) -> DataFrame:
    """Stretches of windows on recurring grams, to be met under their gram; windows on hot grams under their own hash.

    Of the windows on hot grams only the first of each slice is sent; the
    others are hits upon it already, and are passed on as such.
    """
    schema = _schema(_ASK)

    def sent(key, doc, row, place, size, windows, source=None) -> pa.RecordBatch:
        n = len(key)
        if windows is None:
            blob = pa.nulls(n, pa.binary())
        else:
            ends = np.zeros(n + 1, np.int32)
            np.cumsum(size * 8, out=ends[1:])
            blob = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(windows))])
        source = [pa.array(x) for x in source] if source else [pa.nulls(n, pa.int64())] * 3
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, doc, row, place, size)] + [blob, *source], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for rows, data, offsets in _sliced(batches, "text"):
            w = Windows(hasher, data, offsets, window, gram)
            docs_, hashes = rows.column("doc").to_numpy(), rows.column("row").to_numpy()
            kept = _is_set(recurring.value, w.gram)
            very = kept & _is_set(hot.value, w.gram)
            plain = np.flatnonzero(kept & ~very)
            if len(plain):
                of = np.repeat(kept & ~very, w.size)
                first, text = w.first[plain], w.text[w.first[plain]]
                yield sent(_signed(w.gram[plain]), docs_[text], hashes[text], w.place[first], w.size[plain], w.hash[of])
            if very.any():
                at = np.flatnonzero(np.repeat(very, w.size))
                _, rank = np.unique(np.stack([docs_, hashes], axis=1), axis=0, return_inverse=True)
                order = at[np.lexsort((w.place[at], rank.ravel()[w.text[at]], w.hash[at]))]
                leads = np.flatnonzero(np.diff(w.hash[order], prepend=~w.hash[order[:1]]) != 0)
                first = order[leads]
                yield sent(_signed(w.hash[first]), docs_[w.text[first]], hashes[w.text[first]], w.place[first], np.ones(len(first), np.int64), w.hash[first])
                source = np.repeat(first, np.diff(leads, append=len(order)))
                again = np.flatnonzero(order != source)
                own, source = order[again], source[again]
                by = np.argsort(own)
                own, source = own[by], source[by]
                columns, size = _joined(
                    (docs_[w.text[own]], hashes[w.text[own]], w.place[own], docs_[w.text[source]], hashes[w.text[source]], w.place[source]), np.ones(len(own), np.int64)
                )
                if len(size):
                    yield sent(_signed(mixed(columns[1].view(np.uint64))), *columns[:3], size, None, columns[3:])
        release()

    return docs.select("doc", "row", "text").mapInArrow(run, _ASK)


def _met(asked: DataFrame) -> DataFrame:
    """The windows that an earlier document or place has too: (doc, row, place, size windows, and where the first are)."""
    schema = _schema(_HIT)

    def told(columns: Sequence[np.ndarray], size: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*columns[:3], size, *columns[3:])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = [np.zeros(0, np.int64)] * 5  # the first of each window of the last key
        for t in _gathered(batches):
            done = t.filter(t.column("windows").is_null())
            if done.num_rows:
                yield pa.RecordBatch.from_arrays([done.column(n) for n in schema.names], schema=schema)
            t = t.filter(t.column("windows").is_valid())
            if not t.num_rows:
                continue
            key, doc, row, place, size = (t.column(n).to_numpy() for n in ("key", "doc", "row", "place", "size"))
            window = np.frombuffer(b"".join(t.column("windows").to_pylist()), np.int64)
            inside = np.arange(len(window)) - np.repeat(np.cumsum(size) - size, size)
            every = [np.repeat(key, size), window, np.repeat(doc, size), np.repeat(row, size), np.repeat(place, size) + inside]
            carry = carried[0][:1] == key[:1]
            lead = len(carried[0]) if carry.any() else 0
            if lead:
                every = [np.concatenate([a, b]) for a, b in zip(carried, every)]
            order = np.lexsort((every[1], every[0]))  # stable: within a window by document and place
            k, w = every[0][order], every[1][order]
            is_first = np.ones(len(order), bool)
            is_first[1:] = (k[1:] != k[:-1]) | (w[1:] != w[:-1])
            leads = np.flatnonzero(is_first)
            first = np.empty(len(order), np.int64)
            first[order] = np.repeat(order[leads], np.diff(leads, append=len(order)))
            doc, row, place = every[2:]
            again = np.flatnonzero((doc != doc[first]) | (row != row[first]) | (place != place[first]))
            again = again[again >= lead]
            source = first[again]
            if len(again):
                yield told(*_joined((doc[again], row[again], place[again], doc[source], row[source], place[source]), np.ones(len(again), np.int64)))
            mine = order[leads]
            mine = np.sort(mine[every[0][mine] == key[-1]])
            carried = [x[mine] for x in every]
        release()

    return asked.repartition("key").sortWithinPartitions("key", "doc", "row", "place").mapInArrow(run, _HIT)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc, row, place, size, from_doc, from_row, from_place): windows that start earlier too, and an earlier start.

    ``docs`` has (doc, row, text).  A window is known by its least gram of
    ``gram`` words, so windows that are equal stand on equal grams.  Grams
    are counted first; only stretches of windows on grams that recur are
    shuffled, a row for some six windows.  The windows of a gram with over
    ``hot`` places are shuffled under their own hashes instead, each slice of
    documents sending its first.
    """
    if not 0 < gram <= window:
        raise ValueError("gram is between 1 and window")
    context = docs.sparkSession.sparkContext
    counted = materialize(_grams(docs, window, gram), "grams")
    recurring = context.broadcast(bit_table(counted.select("gram"), GRAM_BITS))
    very = context.broadcast(bit_table(counted.where(c("n") > hot).select("gram"), GRAM_BITS))
    return materialize(_met(_asked(docs, recurring, very, window, gram)), "repeats")


def _only(rows: DataFrame, bits, wanted: bool = True) -> DataFrame:
    """The rows whose ``at`` is in the bit table, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_is_set(bits.value, batch.column("at").to_numpy()) == wanted))

    return rows.mapInArrow(run, rows.schema)


def _passages(requests: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """The words of every asked passage, cut from the document where it stands first."""
    keys = "from_doc long, from_row long, from_place long, size long"
    schema = pa.schema([*_schema(keys), pa.field("passage", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        words: list[str] = []
        for batch in batches:
            for doc, row, place, size, text in zip(*[batch.column(i) for i in range(5)]):
                if not place.is_valid:
                    words = _WORD.findall(text.as_py() or "")
                else:
                    yield doc.as_py(), row.as_py(), place.as_py(), size.as_py(), " ".join(words[place.as_py() :][: size.as_py() + window - 1])

    names = ["from_doc", "from_row", "from_place", "size"]
    asked = requests.select(*names).distinct().select(*names, F.lit(None).cast("string").alias("text"))
    null = F.lit(None).cast("long")
    given = docs.select(c("doc").alias("from_doc"), c("row").alias("from_row"), null.alias("from_place"), null.alias("size"), "text")
    both = given.unionByName(asked).repartition("from_doc", "from_row").sortWithinPartitions("from_doc", "from_row", c("from_place").asc_nulls_first())
    return both.mapInArrow(lambda batches: batched(each(batches), schema, 256), keys + ", passage string")


class Locator:
    """Automata over words that find every occurrence of the passages."""

    def __init__(self, passages: dict[tuple[int, ...], tuple], words: dict[str, int], size: int = AUTOMATON):
        self._words, self._automata, held = words, [], 0
        for passage, source in passages.items():
            if not self._automata or held + len(passage) > size:
                self._automata.append(ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE))
                held = 0
            self._automata[-1].add_word(passage, (len(passage), source))
            held += len(passage)
        for a in self._automata:
            a.make_automaton()

    def removed(self, doc: int, row: int, words: list[str]) -> np.ndarray:
        """Which of the document's words lie in an occurrence after its passage's source."""
        ids = tuple(map(self._words.get, words, repeat(0)))
        change = np.zeros(len(words) + 1, np.int64)
        for automaton in self._automata:
            for end, (length, source) in automaton.iter(ids) if ids else ():
                if (doc, row, end + 1 - length) > source:
                    change[end + 1 - length] += 1
                    change[end + 1] -= 1
        return np.cumsum(change[:-1]) > 0


def _located(requests: DataFrame, passages: DataFrame, docs: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``docs`` after removal, block by block: a block's passages make its automata, its documents stream through them."""
    keys = ["from_doc", "from_row", "from_place", "size"]
    asked = requests.join(passages, keys).select(
        "block", c("from_doc").alias("doc"), c("from_row").alias("row"), c("from_place").alias("place"), F.lit(None).cast("long").alias("doc_id"), c("passage").alias("text")
    )
    given = docs.select(_block(blocks), "doc", "row", F.lit(None).cast("long").alias("place"), "doc_id", "text")
    both = asked.unionByName(given).repartition("block").sortWithinPartitions("block", c("place").isNull(), "doc", "row", "place")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows = (tuple(x.as_py() for x in row) for batch in batches for row in zip(*[batch.column(i) for i in range(6)]))
        for _, block in groupby(rows, lambda row: row[0]):
            passages, words, tool = {}, {}, None
            for _, doc, row, place, doc_id, text in block:
                if place is not None:
                    passage = tuple(words.setdefault(w, len(words) + 1) for w in text.split(" "))
                    source = (doc, row, place)
                    passages[passage] = min(passages.get(passage, source), source)
                    continue
                tool = tool or Locator(passages, words)
                told = _WORD.findall(text or "")
                yield _result(doc_id, told, tool.removed(doc, row, told))
        release()

    return both.mapInArrow(lambda batches: batched(each(batches), RESULT, 256), _RESULT)


_RESULT = "doc_id long, n_words long, n_removed long, text string, removed array<struct<start:long,end:long>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string()), ("removed", pa.list_(_SPAN))])


def _result(doc_id: int | None, words: list[str], gone: np.ndarray | None) -> tuple:
    if gone is None or not gone.any():
        return doc_id, len(words), 0, " ".join(words), []
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2).tolist()
    kept = [w for w, g in zip(words, gone.tolist()) if not g]
    return doc_id, len(words), int(gone.sum()), " ".join(kept), [{"start": a, "end": b} for a, b in edges]


def _untouched(docs: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield _result(doc_id, _WORD.findall(text.as_py() or ""), None)
        release()

    return docs.select("doc_id", "text").mapInArrow(lambda batches: batched(each(batches), RESULT, 256), _RESULT)


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("doc", "row", F.lit(1)), F.lit(blocks)).cast("long").alias("block")


def _requests(hits: DataFrame, blocks: int) -> DataFrame:
    """(block, from_doc, from_row, from_place, size): the passages that a block's documents repeat; neighbouring hits are one."""
    names = "block long, from_doc long, from_row long, from_place long, size long"
    schema = _schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered(batches):
            block, size = t.column("block").to_numpy(), t.column("size").to_numpy()
            columns = [t.column(n).to_numpy() for n in ("doc", "row", "place", "from_doc", "from_row", "from_place")]
            (_, _, _, doc, row, place), total = _joined(columns, size)
            first = np.searchsorted(np.cumsum(size), np.cumsum(total) - total, "right")  # the run's first hit, for its block
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block[first], doc, row, place, total)], schema=schema)

    dealt = hits.withColumn("block", _block(blocks)).repartition("block").sortWithinPartitions("block", "doc", "row", "place")
    return dealt.mapInArrow(run, names).distinct()


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_removed, text, removed) of every row of ``docs`` (doc_id, text).

    Words are runs of signs other than white space.  Every word goes that
    lies in ``window`` consecutive words of its document that also start
    earlier: in a document of a smaller id, or before in the same.  ``text``
    has the words left, with one space between; ``removed`` the spans of the
    words that went, counted in the words given.

    1. Recurring windows are confirmed by counts (``repeats``); each that is
       not the first names where it stands earlier, and neighbours make one
       passage.  2. The passages' words are cut from the documents in which
       they stand earlier.  3. Documents with a repeat are dealt into blocks
       of some ``block`` repeated windows; a block's passages, each once, are
       compiled into Aho-Corasick automata over words, and the block's
       documents stream through them, which locates every occurrence word by
       word.  Occurrences after a passage's source go.

    Hashes only choose passages; what goes has been found word by word.  Two
    bit tables of 16 MB and two of 2 MB go to every executor, whatever the
    size of the input; a table that fills up lets more through and changes
    no result.  The automata of a block and one document are held at a time.

    A null text has no words.  Rows with one id are documents in the order of
    their texts' hashes; rows equal in id and text are one document, so none
    is earlier than the other.  Null ids come last, likewise by their texts.
    No rows give no rows.
    """
    context = docs.sparkSession.sparkContext
    rows = _documents(docs)
    hits = repeats(rows, window, gram, hot)
    blocks = max(1, -(-(hits.agg(F.sum("size")).first()[0] or 0) // block))
    touched = context.broadcast(bit_table(hits.select(F.xxhash64("doc", "row").alias("at")), DOCUMENT_BITS))
    sources = context.broadcast(bit_table(hits.select(F.xxhash64("from_doc", "from_row").alias("at")), DOCUMENT_BITS))
    requests = materialize(_requests(hits, blocks), "requests")
    passages = materialize(_passages(requests, _only(rows, sources), window), "passages")
    return _located(requests, passages, _only(rows, touched), blocks).unionByName(_untouched(_only(rows, touched, False)))


def op13_repeated_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


OP13_SQL = f"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(len(w) - {WINDOW - 1})) AS i FROM words WHERE len(w) >= {WINDOW}
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1 : i + {WINDOW}], ' ')) AS h FROM starts
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range({WINDOW})) AS j FROM again
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS j FROM words
), kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n FROM each e ANTI JOIN gone g USING (doc_id, j) GROUP BY e.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words LEFT JOIN kept k USING (doc_id)
"""
