"""Benchmark decontamination with a generalised suffix automaton of the test items.

The normalised words of all items build one automaton over words. Training text
streams through it: at each word the state and the length of the longest match that
ends there. A match of ``window`` words or more (or of a whole shorter item) is a hit;
the states on the suffix links give the items. Stretches of text that can't reach a
window are not walked: a stretch is walked only where every ``gram`` consecutive words
occur in some item, ``gram`` being the shortest window (items under four words: looked
up by their own fingerprint). This skips no match.

The items are dealt into shards of bounded size. Tasks build an automaton of each shard and write
it, pickled and compressed, as a row of a table in the shared folder; the driver passes these
rows on as one broadcast each, a row at a time, and holds no automaton. Tasks on documents
go through the shards one after the other and let go of one before they load the next
(a single shard stays loaded). Documents are not shuffled.

Defined results: null or wordless text: no words, no hits; null or wordless items match
nothing; rows that share an item id count as one item, and an item with a null id marks
words but is not listed; empty tables: nothing is hit, or no rows. Repeated rows are
judged each by itself. Other columns are not read unless carried.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import discard, expand, squeeze, written
from webmetrics.llm.frames import mapped, narrowed, ship
from webmetrics.llm.window_dedup import without
from webmetrics.llm.words import NOT_ALNUM, Texts, Words, covered

SHARD_BYTES = 1 << 20       # of item text; its automaton takes some 200 MB
SHORT = 4


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.window = window
        w = Words(Texts(pa.array([t for _, t in items], pa.string())), NOT_ALNUM, lower=True)
        self.vocabulary, numbers = np.unique(w.hashes, return_inverse=True)
        seqs = [(i, numbers[a:b].tolist()) for (i, _), a, b in zip(items, w.offsets[:-1], w.offsets[1:], strict=True) if b > a]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        for _, seq in seqs:
            last = 0
            for c in seq:
                last = self._add(last, c)
        self.items: list[set | None] = [None] * len(self.len)      # of the states that hold a window
        short: dict[int, list] = {}
        for i, seq in seqs:
            state = 0
            for c in seq:
                state = self.next[state][c]
                if len(seq) >= window:
                    s = self._holder(state)
                    if s is not None:
                        self.items[s] = (self.items[s] or set()) | {i}
            if len(seq) < window:
                short.setdefault(state, []).append((len(seq), i))
        self.ends: list[list] = [[]] * len(self.len)
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.ends[s] = short.get(s, []) + self.ends[self.link[s]]
        lengths = [min(len(s), window) for _, s in seqs]
        self.gram = min((n for n in lengths if n >= SHORT), default=0)
        self.grams = self._fingerprints(w, self.gram)
        self.tiny = {n: self._fingerprints(w, n, whole=True) for n in range(1, min(SHORT, window)) if n in lengths}

    def _fingerprints(self, w: Words, k: int, whole: bool = False) -> np.ndarray:
        if not k:
            return np.zeros(0, np.uint64)
        s = w.window_starts(k)
        if whole:
            size = np.diff(w.offsets)
            s = s[size[w.doc[s]] == k]
        return np.unique(w.windows(s, k))

    def _add(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._split(last, c, q)
        cur = self._state(self.len[last] + 1)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return cur

    def _state(self, n: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.len.append(n)
        return len(self.len) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        twin = self._state(self.len[p] + 1)
        self.next[twin], self.link[twin] = dict(self.next[q]), self.link[q]
        self.link[q] = twin
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _holder(self, s: int) -> int | None:
        """The state, on the suffix links from s, that holds the last ``window`` words."""
        if self.len[s] < self.window:
            return None
        while self.len[self.link[s]] >= self.window:
            s = self.link[s]
        return s

    def walk(self, numbers: list[int]):
        """(position, hit length, items) of every window that ends at a position."""
        state = size = 0
        for at, c in enumerate(numbers):
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.len[state]
            if c in self.next[state]:
                state = self.next[state][c]
                size += 1
            else:
                state = size = 0
            if size >= self.window:
                found = self.items[self._holder(state)]
                if found is not None:
                    yield at, self.window, found
            for n, i in self.ends[state]:
                if n <= size:
                    yield at, n, (i,)

    def hits(self, w: Words, gone: np.ndarray, found: dict[int, set]) -> None:
        """Marks hit words; adds each text's items."""
        if not len(self.vocabulary) or not len(w):
            return
        hot = np.zeros(len(w), bool)
        for k, keys in [(self.gram, self.grams), *self.tiny.items()]:
            if k and len(keys):
                s = w.window_starts(k)
                hot |= covered(len(w), s[_among(w.windows(s, k), keys)], k)
        edge = np.zeros(len(w), bool)
        edge[w.offsets[:-1][w.offsets[:-1] < len(w)]] = True
        first = hot & (edge | ~np.concatenate([[False], hot[:-1]]))
        starts = np.flatnonzero(first)
        stop = np.flatnonzero(hot & np.concatenate([first[1:] | ~hot[1:], [True]])) + 1
        doc = np.searchsorted(w.offsets, starts, side="right") - 1
        for a, b, d in zip(starts.tolist(), stop.tolist(), doc.tolist(), strict=True):
            h = w.hashes[a:b]
            n = np.searchsorted(self.vocabulary, h)
            n[~_among(h, self.vocabulary)] = -1
            for at, size, items in self.walk(n.tolist()):
                gone[a + at - size + 1:a + at + 1] = True
                found.setdefault(d, set()).update(items)


def _among(h: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return keys[at] == h


def automata(benchmark: DataFrame, item: str, text: str, window: int, shard_bytes: int = SHARD_BYTES) -> list:
    """Broadcast bodies of automata, each of a shard of about ``shard_bytes`` of item text."""
    spark = benchmark.sparkSession
    ship(spark)
    b = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).where(F.col("t").isNotNull())
    size = b.select(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // shard_bytes))

    def build(shard, rows):
        made = Automaton(list(zip(rows["i"].to_pylist(), rows["t"].to_pylist(), strict=True)), window)
        body = squeeze(np.frombuffer(pickle.dumps(made, protocol=5), np.uint8))
        return pa.table({"shard": pa.array([shard[0].as_py()], pa.int64()), "body": pa.array([body], pa.binary())})

    sharded = b.withColumn("shard", F.pmod(F.xxhash64("i", "t"), F.lit(n))).groupBy("shard")
    made = written(sharded.applyInArrow(build, "shard long, body binary").repartition(n, "shard"), "automata")
    out = [spark.sparkContext.broadcast(bytes(r["body"])) for r in made.select("body").toLocalIterator()]
    discard(made)
    return out


def loaded(body) -> Automaton:
    """A broadcast shard's automaton; the worker lets go of the body itself."""
    made = pickle.loads(expand(body.value, np.uint8).tobytes())
    vars(body).pop("_value", None)      # read again from its file when asked again
    return made


def decontaminate(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = 10,
                  max_coverage: float = 0.5, carry=(), shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: id, carried columns, n_words, n_hit, items (sorted),
    clean_text (the text without hit words) and kept (false where more than
    ``max_coverage`` of the words are hit)."""
    shards = automata(benchmark, item, item_text, window, shard_bytes)
    kept: list[Automaton] = []      # in a worker: the automaton, if there is one only

    def judge(batch):
        w = Words(Texts(batch.column("text")), NOT_ALNUM, lower=True)
        gone, found = np.zeros(len(w), bool), {}
        for s in shards:
            made = kept[0] if kept else loaded(s)
            if len(shards) == 1 and not kept:
                kept.append(made)
            made.hits(w, gone, found)
            del made
        n = np.diff(w.offsets)
        total = np.concatenate([[0], np.cumsum(gone)])
        hit = total[w.offsets[1:]] - total[w.offsets[:-1]]
        full = batch.column("text")
        clean = [without(w, i, gone) if hit[i] else full[i].as_py() for i in range(len(n))]
        return {"n_words": pa.array(n, pa.int64()), "n_hit": pa.array(hit, pa.int64()),
                "items": pa.array([sorted(x for x in found.get(i, ()) if x is not None) for i in range(len(n))], pa.list_(pa.string())),
                "clean_text": pa.array(clean, pa.string()), "kept": pa.array(hit <= max_coverage * n, pa.bool_())}

    return mapped(narrowed(docs, ident, text, carry), judge,
                  "n_words long, n_hit long, items array<string>, clean_text string, kept boolean", ident, carry, text)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: items of ``benchmark`` in ``documents``."""
    r = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))
