"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of its labelled texts. A text
is cut greedily into phrases, each the longest match in the automaton; the language
that needs the fewest phrases per symbol wins. Symbols are lower-cased bytes; runs of
anything but letters count as one blank. All of a text is parsed, in segments of
``SEGMENT`` symbols side by side (a phrase ends with its segment), so that one table
lookup steps through thousands of segments at once.

The sample (the only thing fitted) is bounded by documented parameters: per language
``SAMPLE_DOCS`` labelled documents with the smallest hashes, ``SAMPLE_CHARS`` characters
of each. Every language with a labelled text is learned. A model holds each automaton as
compressed edges; the dense tables of more than ``HELD`` languages are made one after the
other for each batch of texts. Prediction uses the text alone.

Defined results: null text or no letter: ``und`` with score 0; no labelled text: ``und``
for all; equal counts: the language first by name; score: how far the winner is ahead,
1 - phrases(first) / phrases(second), 1 with one language; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import expand, squeeze
from webmetrics.llm.frames import mapped, narrowed
from webmetrics.llm.words import LOWER, Texts

SAMPLE_DOCS = 48
SAMPLE_CHARS = 1500
SEGMENT = 256
HELD = 8      # languages whose dense tables a task keeps
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


def symbols(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letter bytes with runs of anything else as one blank (32); offsets."""
    d = LOWER[t.data]
    d = np.where(_LETTER[d], d, np.uint8(32))
    keep = np.ones(len(d), bool)
    keep[1:] = (d[1:] != 32) | (d[:-1] != 32)
    edge = t.offsets[:-1][t.offsets[:-1] < len(d)]
    keep[edge] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return d[keep], total[t.offsets]


def automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a byte string."""
    nxt, link, size, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


class Model:
    """Automata by language over the symbols seen in any sample."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        texts = {}
        for k in self.langs:
            d, _ = symbols(Texts(pa.array(["\n".join(samples[k])], pa.string())))
            texts[k] = d.tobytes()
        seen = sorted(set(b"".join(texts.values())))
        self.code = np.zeros(256, np.int64)
        self.code[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1            # code 0: seen in no sample, matches nothing
        self.edges = []
        self.dense: dict[int, np.ndarray] = {}
        for k in self.langs:
            nxt = automaton(texts[k])
            by = np.fromiter(chain.from_iterable(nxt), np.uint8)
            to = np.fromiter(chain.from_iterable(e.values() for e in nxt), np.int32)
            self.edges.append([squeeze(x) for x in (np.array([len(e) for e in nxt], np.uint16), by, to)])

    def table(self, k: int) -> np.ndarray:
        """The dense automaton of a language: state and symbol to state, in steps of width."""
        if k in self.dense:
            return self.dense[k]
        out, by, to = [expand(x, kind) for x, kind in zip(self.edges[k], (np.uint16, np.uint8, np.int32), strict=True)]
        t = np.zeros(len(out) * self.width, np.int32)
        t[np.repeat(np.arange(len(out)), out) * self.width + self.code[by]] = to * self.width
        if k < HELD:
            self.dense[k] = t
        return t

    def phrases(self, t: Texts) -> np.ndarray:
        """Phrases that each text needs, by language: (languages, texts)."""
        d, off = symbols(t)
        size = np.diff(off)
        pieces = -(-size // SEGMENT)
        doc = np.repeat(np.arange(len(t)), pieces)
        first = np.concatenate([[0], np.cumsum(pieces)])
        start = off[doc] + (np.arange(len(doc)) - first[doc]) * SEGMENT
        length = np.minimum(off[doc + 1] - start, SEGMENT)
        order = np.argsort(-length, kind="stable")
        start, length, doc = start[order], length[order], doc[order]
        code = self.code[d]
        active = np.searchsorted(-length, -np.arange(SEGMENT), side="left")   # segments longer than j
        out = np.zeros((len(self.langs), len(t)), np.int64)
        for k in range(len(self.langs)):
            table = self.table(k)
            state = np.zeros(len(start), np.int32)
            count = np.zeros(len(start), np.int64)
            for j in range(int(length[0]) if len(length) else 0):
                m = active[j]
                c = code[start[:m] + j]
                to = table[state[:m] + c]
                # a phrase opens at the root (first symbol, or after one that nothing
                # matches, itself a phrase) and where the match can't go on
                count[:m] += (to == 0) | (state[:m] == 0)
                state[:m] = np.where(to == 0, table[c], to)
            out[k] = np.bincount(doc, weights=count, minlength=len(t))
        return out


def fitted(docs: DataFrame, labelled: Column, ident: str, text: str, lang: str) -> Model:
    """A model of the bounded sample of the rows that ``labelled`` selects."""
    rows = docs.where(labelled).select(F.col(f"`{ident}`").alias("i"), F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").alias("l"))
    rows = rows.where("l is not null and length(t) > 0")
    key = F.xxhash64("i", F.octet_length("t"))
    slot = F.pmod(F.xxhash64("i", F.lit(1)), F.lit(SAMPLE_DOCS))
    keys = rows.groupBy("l", slot.alias("s")).agg(F.min(key).alias("k")).select("l", "k").distinct()
    want = rows.select("l", key.alias("k"), F.substring("t", 1, SAMPLE_CHARS).alias("t"))
    found = want.join(F.broadcast(keys), ["l", "k"]).groupBy("l", "k").agg(F.min("t").alias("t"))
    samples: dict[str, list[str]] = {}
    for r in found.orderBy("l", "k").collect():
        samples.setdefault(r["l"], []).append(r["t"])
    return Model(samples)


def identified(docs: DataFrame, model: Model, ident: str = "doc_id", text: str = "text", carry=()) -> DataFrame:
    """One row per document: id, carried columns, lang_pred, score, phrases_per_symbol."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batch):
        m, t = shared.value, Texts(batch.column("text"))
        letter = np.array(batch.column("letter").fill_null(False).to_pylist(), bool)
        if not m.langs:
            letter[:] = False
            n = np.zeros((1, len(t)))
        else:
            n = m.phrases(t)
        best = n.argmin(axis=0)
        low = n.min(axis=0)
        second = np.partition(n, 1, axis=0)[1] if len(n) > 1 else np.full(len(t), np.inf)
        score = np.where(letter, 1 - low / np.maximum(second, 1), 0.0)
        size = np.maximum(np.diff(symbols(t)[1]), 1)
        return {"lang_pred": pa.array([m.langs[k] if x else "und" for k, x in zip(best, letter, strict=True)], pa.string()),
                "score": pa.array(np.clip(score, 0, 1)), "phrases_per_symbol": pa.array(low / size)}

    flat = narrowed(docs, ident, text, carry, letter=F.col(f"`{text}`").rlike(r"\p{L}"))
    return mapped(flat, judge, "lang_pred string, score double, phrases_per_symbol double", ident, carry, text)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: learns from three quarters of ``documents`` (crc32 of the id), predicts all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = fitted(docs, ~held, "doc_id", "text", "lang")
    return identified(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
