"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import materialize, pick, release, table
from tarnwork.llm.tokens import _byte_of, library, vocabulary

c = F.col

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_MARK = "▁"
SHIFT = 15  # a pair is (A id << SHIFT) + B id
KEEP, LONG = 500_000, 10_000  # stretches remembered by one worker; characters beyond which the library itself encodes
WIDE = 64  # links of a group beyond which equal ids are counted first
BROADCAST_PAIRS = 1_000_000  # irregular pairs, 12 bytes each, that may be sent to every executor
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: White space, signs and the Latin letters after them, unless other letters follow; or white space and all up to the next.
_STRETCH = re.compile(rf"\s*[^\s{_LATIN}]*[{_LATIN}]+(?![^\W\d_])|\s*\S+|\s+")
_CONTROL_SPACE = "\x1c\x1d\x1e\x1f"  # white space to Python, not to the tokenizers


class Grown:
    """A numpy array that grows at its end."""

    def __init__(self, kind: type, values: Sequence = ()):
        self._held, self.size = np.zeros(1 << 12, kind), 0
        self.extend(values)

    def extend(self, values: Sequence) -> None:
        more = self.size + len(values)
        if more > len(self._held):
            self._held = np.concatenate([self._held, np.zeros(max(more, len(self._held)), self._held.dtype)])
        self._held[self.size : more] = values
        self.size = more

    @property
    def all(self) -> np.ndarray:
        return self._held[: self.size]


class Aligner:
    """Tokens of space + text under a byte-level vocabulary (A) and a piece vocabulary (B), grouped between common ends.

    Neither vocabulary has a token that goes on from a sign to white space,
    or from a letter to a sign that is none (checked against B's pieces when
    it is read; texts with the white space for which it does not hold are
    encoded whole), so each stretch of white space, signs and the letters
    after them is encoded by itself and remembered.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"] for t in spec.get("added_tokens", [])}
        byte_of = _byte_of()
        ranks = {bytes(byte_of[ch] for ch in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self._core = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._library = library(path_a)
        self._library.encode_special_tokens = True
        self._pieces = b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        told = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = [bytes([int(t[3:5], 16)]) if b.is_byte(i) else t.replace(SPACE_MARK, " ").encode() for i, t in enumerate(told)]
        if len(told) > 1 << SHIFT:
            raise ValueError("the piece vocabulary has too many ids")
        self._mark, self._letter = b.piece_to_id(SPACE_MARK), b.piece_to_id(SPACE_MARK + "a")
        plain = {self.b_bytes[i]: i for i in range(len(told)) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))}
        self.a_bytes = {i: t for t, i in ranks.items()}
        self._size_a = [len(self.a_bytes.get(i, b"")) for i in range(max(ranks.values()) + 1)]
        self._size_b = [len(t) for t in self.b_bytes]
        self._told = [str(i) for i in range(max(len(self._size_a), len(told)))]
        #: The identity map: for each A id the B id of the same bytes, or -1.
        self.same = np.full(max(ranks.values()) + 1, -1, np.int64)
        for token, i in ranks.items():
            self.same[i] = plain.get(token, -1)
        odd = {ch for t in told if len(t) > 1 for ch in t if ch.isspace()}
        common = [told[i] for i in range(len(told)) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))]
        if any(re.search(rf"[^{SPACE_MARK}]{SPACE_MARK}|[{_LATIN}][^\W\d_]*[\W\d_]", t) for t in common):
            odd.add(" ")  # no stretch can be encoded by itself
        self._odd = re.compile("[" + re.escape("".join(odd) + _CONTROL_SPACE) + "]")
        self.forget()

    def forget(self) -> None:
        self._known: dict[str, int] = {}
        self._groups: list[str] = []
        self._counts, self._starts = Grown(np.int64), Grown(np.int64, [0])  # n_a, n_b, n_groups of each; where its pairs start
        self._pairs, self._times = Grown(np.int64), Grown(np.int64)
        self._used = Grown(np.int64)

    def thin(self) -> None:
        """Forget the stretches of fewer than three texts."""
        keep = self._used.all > 2
        starts = self._starts.all
        sizes = np.diff(starts)[keep]
        of = np.repeat(keep, np.diff(starts))
        place = np.cumsum(keep) - 1
        counts, pairs, times = self._counts.all.reshape(-1, 3)[keep].ravel(), self._pairs.all[of], self._times.all[of]
        left = {t: int(place[i]) for t, i in self._known.items() if keep[i]}
        groups = [g for g, k in zip(self._groups, keep.tolist()) if k]
        self.forget()
        if len(left) < KEEP // 2:
            self._known, self._groups = left, groups
            for grown, values in ((self._counts, counts), (self._pairs, pairs), (self._times, times), (self._starts, np.cumsum(sizes)), (self._used, np.ones(len(left)))):
                grown.extend(values)

    def _a(self, text: str) -> list[int]:
        return self._core.encode_ordinary(text) if len(text) <= LONG else self._library.encode(text, add_special_tokens=False).ids

    def align(self, a: list[int], b: list[int]) -> tuple[list[str], list[int], list[int]]:
        """The groups written out, the linked pairs, and how often each is linked; a pair may come again."""
        size_a, size_b, name = self._size_a, self._size_b, self._told
        told, pairs, times = [], [], []
        end_a = end_b = first_a = first_b = i = j = 0
        for token in a:
            i += 1
            end_a += size_a[token]
            while end_b < end_a:
                end_b += size_b[b[j]]
                j += 1
            if end_b > end_a:
                continue
            if i - first_a == 1 and j - first_b == 1:  # one to one: no lists to cross
                told.append(f"{name[token]}|{name[b[first_b]]}")
                pairs.append((token << SHIFT) + b[first_b])
                times.append(1)
            else:
                xs, ys = a[first_a:i], b[first_b:j]
                told.append(",".join([name[x] for x in xs]) + "|" + ",".join([name[y] for y in ys]))
                if len(xs) * len(ys) <= WIDE:
                    pairs += [(x << SHIFT) + y for x in xs for y in ys]
                    times += [1] * (len(pairs) - len(times))
                else:
                    (xs, n), (ys, m) = np.unique(xs, return_counts=True), np.unique(ys, return_counts=True)
                    pairs += ((xs[:, None] << SHIFT) + ys).ravel().tolist()
                    times += (n[:, None] * m).ravel().tolist()
            first_a, first_b = i, j
        return told, pairs, times

    def _whole(self, full: str) -> tuple[np.ndarray, str, np.ndarray, np.ndarray] | None:
        a, b = self._library.encode(full, add_special_tokens=False).ids, self._pieces.encode(full[1:], num_threads=1)
        raw = full.encode()
        if b"".join(self.b_bytes[i] for i in b) != raw or b"".join(self.a_bytes[i] for i in a) != raw:
            return None
        told, pairs, times = self.align(a, b)
        return np.array([len(a), len(b), len(told)]), ";".join(told), *_summed(np.array(pairs, np.int64), np.array(times, np.int64))

    def _learn(self, stretches: list[str]) -> bool:
        """Remember the stretches; False if one of them cannot be encoded by itself."""
        b_bytes, size = self.b_bytes, len(self._groups)
        spaced = [t[0] == " " for t in stretches]
        # The library puts a space first: it stands for the stretch's own, or before a letter that joins nothing after it.
        every = self._pieces.encode([t[1:] if s else "a" + t for t, s in zip(stretches, spaced)], num_threads=1)
        groups, counts, starts, pairs, times = [], [], [], [], []
        for text, is_spaced, b in zip(stretches, spaced, every):
            if not is_spaced:
                if b[0] != self._letter:
                    return False
                del b[0]
            elif len(text) == 1:
                b = [self._mark]
            if b"".join([b_bytes[i] for i in b]) != text.encode():
                return False
            a = self._a(text)
            told, more, often = self.align(a, b)
            groups.append(";".join(told))
            counts += (len(a), len(b), len(told))
            pairs += more
            times += often
            starts.append(len(pairs))
        self._known.update(zip(stretches, range(size, size + len(stretches))))
        self._groups += groups
        self._starts.extend(np.array(starts, np.int64) + self._pairs.size)
        self._used.extend([0] * len(groups))
        for grown, values in ((self._counts, counts), (self._pairs, pairs), (self._times, times)):
            grown.extend(values)
        return True

    def text(self, text: str | None) -> tuple[np.ndarray, str, np.ndarray, np.ndarray] | None:
        """(n_a, n_b, n_groups), the groups, its pairs ascending and how often each is linked; None without tokens."""
        if not text or SPACE_MARK in text:
            return None
        full = " " + text
        if self._odd.search(full):
            return self._whole(full)
        stretches = _STRETCH.findall(full)
        try:
            at = [self._known[s] for s in stretches]
        except KeyError:
            if len(self._known) > KEEP:
                self.thin()
            if not self._learn(list(set(stretches).difference(self._known))):
                return self._whole(full)
            at = [self._known[s] for s in stretches]
        each, times = np.unique(np.array(at, np.int64), return_counts=True)
        self._used.all[each] += 1
        counts = (self._counts.all.reshape(-1, 3)[each] * times[:, None]).sum(axis=0)
        starts = self._starts.all
        sizes = starts[each + 1] - starts[each]
        into = np.repeat(starts[each] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return counts, ";".join([self._groups[i] for i in at]), *_summed(self._pairs.all[into], self._times.all[into] * np.repeat(times, sizes))


def _summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, ascending, with the sum of its times."""
    order = np.argsort(pairs)
    pairs = pairs[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first], np.add.reduceat(times[order], first) if len(first) else times


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process."""
    return Aligner(path_a, path_b)


def _packed(pairs: np.ndarray, linked: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    steps = np.diff(pairs, prepend=0)
    return press.compress(steps.astype("<u4").reshape(-1, 1).view(np.uint8).T.tobytes() + linked.astype("<i8").tobytes())


def _unpacked(packed: bytes, press: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray]:
    raw = press.decompress(packed)
    n = len(raw) // 12
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n).reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps.astype(np.int64)), np.frombuffer(raw, "<i8", n, 4 * n)


ENCODED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pairs binary"


def encoded(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, groups: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): counts, the groups' hash, the packed pairs and, if asked for, the groups."""
    path_a, path_b = path_a or vocabulary(BYTE_BPE), path_b or vocabulary(PIECES)
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.binary()]
    schema = pa.schema(list(zip([x.split()[0] for x in ENCODED.split(", ")], kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, press = aligner(path_a, path_b), zstandard.ZstdCompressor(1)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = tool.text(text.as_py())
                if found is None:
                    out.append((doc_id, 0, 0, 0, 0, "", "" if groups else None, None))
                    continue
                counts, told, pairs, linked = found
                out.append((doc_id, *counts.tolist(), int(linked.sum()), hashlib.sha256(told.encode()).hexdigest(), told if groups else None,
                            _packed(pairs, linked, press)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
        release()

    return pick(docs, doc_id="long", text="string").mapInArrow(run, ENCODED)


def pair_counts(stage: DataFrame, path_a: str | None = None, path_b: str | None = None, flush: int = 2_000_000) -> DataFrame:
    """(pair, one_to_one, n): in how many rows of ``encoded`` each pair is linked.

    Pairs of the identity map are added up in one vector of the length of A's
    vocabulary for each task; only the others are gathered, as distinct pairs
    of a task, and given out whenever ``flush`` of them are held.
    """
    path_a, path_b = path_a or vocabulary(BYTE_BPE), path_b or vocabulary(PIECES)
    schema = pa.schema([("pair", pa.int64()), ("one_to_one", pa.bool_()), ("n", pa.int64())])

    def told(pairs: np.ndarray, n: np.ndarray, identity: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(np.full(len(n), identity)), pa.array(n)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, press = aligner(path_a, path_b).same, zstandard.ZstdDecompressor()
        vector, pairs, n = np.zeros(len(same), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            held = [_unpacked(x.as_py(), press)[0] for x in batch.column(0)]
            every = np.concatenate([*held, np.zeros(0, np.int64)])
            regular = same[every >> SHIFT] == (every & ((1 << SHIFT) - 1))
            vector += np.bincount(every[regular] >> SHIFT, minlength=len(same))
            more, times = np.unique(every[~regular], return_counts=True)
            both, place = np.unique(np.concatenate([pairs, more]), return_inverse=True)
            pairs, n = both, np.bincount(place, weights=np.concatenate([n, times]), minlength=len(both)).astype(np.int64)
            if len(pairs) > flush:
                yield told(pairs, n, False)
                pairs, n = pairs[:0], n[:0]
        seen = np.flatnonzero(vector)
        yield told((seen << SHIFT) + same[seen], vector[seen], True)
        yield told(pairs, n, False)

    found = stage.where("pairs is not null").select("pairs").mapInArrow(run, "pair long, one_to_one boolean, n long")
    return found.groupBy("pair").agg(F.first("one_to_one").alias("one_to_one"), F.sum("n").alias("n"))


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, groups: bool = False,
              broadcast_pairs: int = BROADCAST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(documents, counts): how the tokens of two vocabularies meet in every text, and how often corpus-wide.

    counts: (pair, one_to_one, n), where pair is (A id << SHIFT) + B id.
    documents: one row for each row of ``docs``: doc_id, n_a and n_b tokens,
    n_groups between common ends, n_links between tokens of one group, n_best
    links whose pair is the most frequent of its A id (ties included),
    count_sum of their pairs' counts, groups_sha256, and groups if asked for.

    Texts are encoded once and their pairs written, packed.  The counts of
    the identity map and the best count of each A id are vectors of A's
    length.  The irregular pairs' counts go to every executor if there are
    at most ``broadcast_pairs``; else the documents' irregular pairs are
    joined with them.

    A text that is null, empty, or that one of the vocabularies does not
    give back byte by byte, has no tokens: zeros and an empty hash.  Rows with
    equal or null ids are each counted; no rows give no rows.
    """
    path_a, path_b = path_a or vocabulary(BYTE_BPE), path_b or vocabulary(PIECES)
    stage = materialize(encoded(docs, path_a, path_b, groups).withColumn("rid", F.monotonically_increasing_id()), "encoded")
    counts = materialize(pair_counts(stage, path_a, path_b), "pair-counts")
    context = docs.sparkSession.sparkContext
    size = len(aligner(path_a, path_b).same)

    def vector(df: DataFrame) -> np.ndarray:
        """One entry for each id of A."""
        out, got = np.zeros(size, np.int64), df.toArrow()
        out[got["a"].to_numpy()] = got["n"].to_numpy()
        return out

    a = F.shiftright("pair", SHIFT).alias("a")
    regular = vector(counts.where("one_to_one").select(a, "n"))
    best = vector(counts.groupBy(a).agg(F.max("n").alias("n")))
    irregular = counts.where("not one_to_one").select("pair", "n")
    sent = irregular.count() <= broadcast_pairs
    held = irregular.orderBy("pair").toArrow() if sent else None
    known = (held["pair"].to_numpy(), held["n"].to_numpy()) if sent else None
    shared = context.broadcast((regular, best, known))
    schema = pa.schema([("rid", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (regular, best, known), same, press = shared.value, aligner(path_a, path_b).same, zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for rid, packed in zip(batch.column("rid").to_pylist(), batch.column("pairs")):
                pairs, linked = _unpacked(packed.as_py(), press) if packed.is_valid else (np.zeros(0, np.int64),) * 2
                first = pairs >> SHIFT
                is_regular = same[first] == (pairs & ((1 << SHIFT) - 1))
                n = np.where(is_regular, regular[first], 0)
                if known:
                    n[~is_regular] = known[1][np.searchsorted(known[0], pairs[~is_regular])]
                out.append((rid, int(linked[(n == best[first]) & (n > 0)].sum()), int(n @ linked)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)] if out else [pa.array([], pa.int64())] * 3, schema=schema)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if groups else [])]
    if sent:
        whole = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in stage.schema if f.name in names] + [(x, pa.int64()) for x in ("n_best", "count_sum")])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for more in scored([batch]):
                    yield pa.RecordBatch.from_arrays([batch.column(x) for x in whole.names[:-2]] + more.columns[1:], schema=whole)

        plain = [f"{f.name} {f.dataType.simpleString()}" for f in stage.schema if f.name in names]
        return stage.mapInArrow(run, ", ".join([*plain, "n_best long", "count_sum long"])).select(*names), counts

    regulars = stage.select("rid", "pairs").mapInArrow(scored, "rid long, n_best long, count_sum long")
    links = stage.where("pairs is not null").select("rid", "pairs").mapInArrow(_irregular(path_a, path_b), "rid long, pair long, linked long")
    bests = docs.sparkSession.createDataFrame(pa.table({"a": np.flatnonzero(best), "best": best[best > 0]}))
    met = links.join(irregular, "pair").withColumn("a", F.shiftright("pair", SHIFT)).join(bests, "a")
    others = met.select("rid", F.when(c("n") == c("best"), c("linked")).otherwise(0).alias("n_best"), (c("n") * c("linked")).alias("count_sum"))
    sums = materialize(regulars.unionByName(others).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "scores")
    return stage.join(sums, "rid").select(*names), counts


_ARROW = {"bigint": pa.int64(), "string": pa.string()}


def _irregular(path_a: str, path_b: str):
    schema = pa.schema([(x, pa.int64()) for x in ("rid", "pair", "linked")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, press = aligner(path_a, path_b).same, zstandard.ZstdDecompressor()
        for batch in batches:
            for rid, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                pairs, linked = _unpacked(packed.as_py(), press)
                others = same[pairs >> SHIFT] != (pairs & ((1 << SHIFT) - 1))
                columns = (np.full(int(others.sum()), rid), pairs[others], linked[others])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=schema)

    return run


def op11_identity_map_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))[0]
