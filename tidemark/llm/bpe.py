"""Byte-pair encoding with an index from pairs to their positions.

Each batch of a partition is cut into words; the distinct words of the batch
lie end to end in one array of symbols.  An index maps every adjacent pair that
has a merge rank to all its positions.  The active ranks are taken in ascending
order; one vectorised step joins a pair at all its positions at once and adds
the neighbouring pairs that arise to the lists of their own ranks.  So the work
follows the distinct words, not the text.  The vocabulary is read once by the
driver and broadcast (its size is that of one vocabulary file).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches

CHUNK_CHARS = 8_000_000  # texts encoded together; bounds a task's memory


@cache
def byte_letters() -> list[str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class WordBpe:
    """A tokenizer file of the kind: NFC, white space, lower case; words by a pattern; byte-level BPE with word ends."""

    def __init__(self, spec: dict):
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]], [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
        model = spec["model"]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or spec["decoder"] is not None or model["dropout"] or model["unk_token"] or model["byte_fallback"]:
            raise ValueError("this encoder handles word-end byte-level BPE files without a decoder only")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        vocab: dict[str, int] = model["vocab"]
        self.tokens = np.array([""] * (max([*vocab.values(), *self.special.values()]) + 1), dtype=object)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab.get(x, -1) for x in letters], dtype=np.int64)
        self.final = np.array([vocab.get(x + end, -1) for x in letters], dtype=np.int64)
        left = np.array([vocab[a] for a, _ in model["merges"]], dtype=np.int64)
        right = np.array([vocab[b] for _, b in model["merges"]], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int64)
        pair = (left << 32) | right
        self.by_pair = np.argsort(pair, kind="stable")
        self.pairs = pair[self.by_pair]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 without one."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (a >= 0) & (b >= 0), self.by_pair[at], -1)

    def units(self, text: str) -> list[str]:
        """The normalised text split at blanks and line ends, which no word crosses; a special token is marked by a line end before it."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.normal(text).replace("\n", " ").split(" ")
        return list(chain.from_iterable(["\n" + x] if x in self.special else self.normal(x).replace("\n", " ").split(" ") for x in self.cut.split(text)))

    def normal(self, text: str) -> str:
        """NFC and lower case; white space need not be folded, as no word holds any."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # one letter at a time, as a sigma at a word's end has no form of its own here
        return text.lower() if "Σ" not in text else "σ".join(x.lower() for x in text.split("Σ"))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct ``words`` end to end, and their offsets."""
        data = [w.encode() for w in words]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        off = np.concatenate([[0], np.cumsum(lengths)])
        raw = np.frombuffer(b"".join(data), dtype=np.uint8)
        sym = self.inner[raw]
        ends = off[1:][lengths > 0] - 1
        sym[ends] = self.final[raw[ends]]
        sym[sym < 0] = -2  # a letter that the vocabulary lacks; it joins with nothing and gives no id
        word = np.repeat(np.arange(len(words)), lengths)
        n = len(sym)
        right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
        same = word[1:] == word[:-1]
        right[:-1][~same], left[1:][~same] = n, -1
        right[-1:] = n
        alive = np.ones(n, dtype=bool)
        joined = np.zeros(n, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}  # rank: positions of the pair's left symbol
        queue: list[int] = []

        def note(at: np.ndarray) -> None:
            r = self.ranks(sym[at], sym[right[at]])
            at, r = at[r >= 0], r[r >= 0]
            if len(r):
                o = np.argsort(r, kind="stable")
                at, r = at[o], r[o]
                cuts = np.flatnonzero(np.diff(r)) + 1
                for k, p in zip(r[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
                    if k not in index:
                        index[k] = []
                        heapq.heappush(queue, k)
                    index[k].append(p)

        note(np.flatnonzero(right < n))
        a_of, b_of = np.empty(len(self.pairs), np.int64), np.empty(len(self.pairs), np.int64)
        a_of[self.by_pair], b_of[self.by_pair] = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        while queue:
            k = heapq.heappop(queue)
            lists = index.pop(k)
            at = np.sort(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b = a_of[k], b_of[k]
            at = at[alive[at] & (sym[at] == a)]
            at = at[right[at] < n]
            at = at[sym[right[at]] == b]
            if len(lists) > 1 and len(at) > 1:
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            if a == b and len(at) > 1:  # in a run of one symbol every second pair is free
                linked = np.concatenate([[False], right[at[:-1]] == at[1:]])
                start = np.flatnonzero(~linked)
                step = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
                at = at[step % 2 == 0]
            if not len(at):
                continue
            gone = right[at]
            after = right[gone]
            sym[at] = self.made[k]
            alive[gone] = False
            right[at] = after
            left[after[after < n]] = at[after < n]
            before = left[at]
            before = before[before >= 0]
            joined[at] = True
            touched = np.concatenate([before[~joined[before]], at[after < n]])  # a joined pair that stands before another is in the second part
            joined[at] = False
            if len(touched):
                note(touched)
        keep = alive & (sym >= 0)
        return sym[keep], np.concatenate([[0], np.cumsum(keep)])[off]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """Ids of each text and the text decoded from them.

        A file without a decoder puts a blank between tokens.
        """
        number: dict[str, int] = defaultdict(count().__next__)
        rows = []
        for t in texts:
            u = self.units(t)
            rows.append(np.fromiter(map(number.__getitem__, u), np.int64, len(u)))
        piece: dict[str, int] = defaultdict(count().__next__)
        owned = [[u] if u[:1] == "\n" else self.words.findall(u) for u in number]
        of_unit = np.fromiter(map(piece.__getitem__, chain.from_iterable(owned)), np.int64)
        pieces_to = np.concatenate([[0], np.cumsum(np.fromiter(map(len, owned), np.int64, len(owned)))])
        words = list(piece)
        ids, off = self.encode_words(["" if w[0] == "\n" else w for w in words])
        if special := [k for k, w in enumerate(words) if w[0] == "\n"]:
            at = np.array(special, dtype=np.int64)
            ids = np.insert(ids, off[at], [self.special[words[k][1:]] for k in special])
            off = off + np.searchsorted(at, np.arange(len(words) + 1), side="left")
        ids, off = _gather(ids, off, of_unit)
        off = off[pieces_to]
        tokens = self.tokens[ids].tolist()
        spelt = [" ".join(tokens[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        out, decoded = [], []
        for w in rows:
            out.append(_gather(ids, off, w)[0])
            decoded.append(" ".join(filter(None, map(spelt.__getitem__, w.tolist()))))
        return out, decoded


def _gather(flat: np.ndarray, off: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ``flat`` end to end, and their offsets."""
    n = off[which + 1] - off[which]
    to = np.concatenate([[0], np.cumsum(n)])
    return flat[np.repeat(off[which] - to[:-1], n) + np.arange(to[-1])], to


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


_made: dict[bytes, WordBpe] = {}


def _tokenizer(spec: str) -> WordBpe:
    """One instance for a Python worker and tokenizer file."""
    key = hashlib.sha256(spec.encode()).digest()
    if key not in _made:
        _made.clear()
        _made[key] = WordBpe(json.loads(spec))
    return _made[key]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _encoded(shared, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _tokenizer(shared.value)
        for b in batches:
            texts = b.column(1).fill_null("").to_pylist()
            for i, j in _chunks(texts):
                rows, decoded = bpe.encode(texts[i:j])
                n = pa.array([len(r) for r in rows], pa.int64())
                if digest:
                    more = [
                        pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
                        pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                    ]
                    names = ["ids_sha256", "decoded_sha256"]
                else:
                    off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
                    flat = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
                    more, names = [pa.ListArray.from_arrays(pa.array(off), pa.array(flat)), pa.array(decoded, pa.string())], ["ids", "decoded"]
                yield pa.record_batch([b.column(0).slice(i, j - i), n, *more], names=["doc_id", "n_tokens", *names])

    return run


def _share(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(json.dumps(load(path)))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (array of int), decoded text, for every row.

    The whole text is encoded without special tokens added, and decoded with
    none skipped.  A null or empty text has no ids and an empty decoded text;
    rows that repeat an id are encoded each; a null id stays null; a very long
    text is one row of one task, encoded by its distinct words; ties between
    pairs go to the smaller rank; other columns are ignored; an empty table
    gives no rows.
    """
    return bounded_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_encoded(_share(docs.sparkSession, path), False), "doc_id long, n_tokens long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with digests in place of ids and decoded text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bounded_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_encoded(_share(docs.sparkSession, path), True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
