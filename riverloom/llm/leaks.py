"""Problem 8: held-out evaluation passages inside corpus documents."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import sentences
from .common import map_columns, spread, stored

#: Hashed terms, rank of the latent space, words of a window, step between windows of documents and of items.
TERMS, RANK, WINDOW, STEP, ITEM_STEP = 1 << 15, 80, 18, 7, 4
#: A window of a document is a candidate for an item from this cosine in the latent space on.
COSINE = 0.5
#: What a leak is: so many consecutive words of the passage, with at most one in CHANGED of them changed.
LEAST, CHANGED = 15, 10
_BLOCKS = 64
#: Items that are searched at once: with their windows and vectors about 100 MB at most for items of a page.
ITEM_BLOCK = 2000
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+")
_SOLID = re.compile(r"[฀-๿຀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿]")
_TABLE = {i: None for i in range(0x0300, 0x0370)} | {i: None for i in (0xAD, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0xFEFF)}


def words(text: str) -> list[str]:
    """Lower-case words without accents or invisible characters; a script without spaces gives its characters."""
    t = unicodedata.normalize("NFKD", text.lower()).translate(_TABLE) if not text.isascii() else text.lower()
    out = _TOKEN.findall(t)
    if _SOLID.search(t):
        split: list[str] = []
        for w in out:
            split += list(w) if _SOLID.search(w) else [w]
        return split
    return out


def passage(text: str) -> tuple[str, str]:
    """(passage, closing question or instruction): the last unit closes, where there are more."""
    u = sentences.fitted().units(text)
    if len(u) < 2:
        return text, ""
    return text[: u[-1][0]], text[u[-1][0] :]


# ---------------------------------------------------------------------------------------------
# latent space


class Vectors:
    """TF-IDF windows over hashed terms: word unigrams, or character pairs in scripts without spaces."""

    def __init__(self, idf: np.ndarray):
        self.idf = idf.astype(np.float32)
        self.memo: dict[str, int] = {}

    def ids(self, ws: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > 400_000:
            memo.clear()
        if any(len(w) == 1 and w > "⹿" for w in ws):
            ws = [a + b if len(a) == 1 == len(b) else a for a, b in zip(ws, [*ws[1:], ""])]
        out = []
        for w in ws:
            i = memo.get(w)
            if i is None:
                i = memo[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % TERMS
            out.append(i)
        return np.array(out, dtype=np.int64)

    def windows(self, ids: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of overlapping windows, rows of unit length."""
        n = len(ids)
        starts = np.arange(0, max(1, n - WINDOW + step), step)
        starts = np.minimum(starts, max(0, n - WINDOW))
        at = starts[:, None] + np.arange(min(WINDOW, n))
        t = ids[at]
        w = self.idf[t]
        if t.shape[1] < WINDOW:
            pad = ((0, 0), (0, WINDOW - t.shape[1]))
            t, w = np.pad(t, pad), np.pad(w, pad)
        norm = np.sqrt((w * w).sum(1, keepdims=True))
        return t, w / np.maximum(norm, 1e-9)


def _project(t: np.ndarray, w: np.ndarray, q: np.ndarray) -> np.ndarray:
    out = np.empty((len(t), q.shape[1]), dtype=np.float32)
    for i in range(0, len(t), 1024):
        out[i : i + 1024] = np.einsum("wt,wtl->wl", w[i : i + 1024], q[t[i : i + 1024]], optimize=False)
    return out


def _gram(t: np.ndarray, w: np.ndarray, q: np.ndarray, into: np.ndarray) -> None:
    """into += A' (A q) for the rows (t, w) of A."""
    for i in range(0, len(t), 1024):
        a, b = t[i : i + 1024], w[i : i + 1024]
        z = np.einsum("wt,wtl->wl", b, q[a], optimize=False)
        flat = a.ravel()
        order = np.argsort(flat, kind="stable")
        values = (b[:, :, None] * z[:, None, :]).reshape(-1, q.shape[1])[order]
        keys, starts = np.unique(flat[order], return_index=True)
        into[keys] += np.add.reduceat(values, starts, axis=0)


def hashed(documents: DataFrame) -> DataFrame:
    """(doc_id, text, ids): the hashed terms of each text that has any, tokenised once and written to the shared folder; later steps read only what they need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vectors(np.ones(TERMS))
        for b in batches:
            ids = [v.ids(words(t)) if t else _NONE for t in b.column(1).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate([_NONE, *ids]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "text", "ids"])

    kind = dict(documents.dtypes)["doc_id"]
    rows = spread(documents.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, text string, ids array<int>")
    return stored(rows.where(F.size("ids") > 0))


_NONE = np.zeros(0, dtype=np.int64)


def _lists(batches: Iterator[pa.RecordBatch]):
    """The hashed terms of each text of a batch."""
    for b in batches:
        c = b.column(0)
        flat, ends = np.asarray(c.flatten(), dtype=np.int64), np.cumsum(np.asarray(c.value_lengths()))
        yield np.split(flat, ends[:-1]) if len(c) else []


def _gathered(ids: DataFrame) -> DataFrame:
    """As many tasks as the cluster runs at once, twice over: each adds up its own part, so what is shuffled doesn't grow with the corpus."""
    most = 2 * ids.sparkSession.sparkContext.defaultParallelism
    return ids.select("ids").coalesce(most)


def _sum_blocks(parts: DataFrame, size: int) -> np.ndarray:
    """Add up matrices of ``size`` numbers that come as blocks of rows, as a tree: SALTS sums a block, then one.

    A task adds row by row and holds one block of each key at a time, whatever the number of parts.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for k, salt, p in zip(*(b.column(i).to_pylist() for i in range(3))):
                x = np.frombuffer(p, dtype=np.float32)
                if (k, salt) in total:
                    total[k, salt] += x
                else:
                    total[k, salt] = x.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in total], pa.int32()), pa.array([0] * len(total), pa.int32()), pa.array([t.astype(np.float32).tobytes() for t in total.values()], pa.binary())], names=["block", "salt", "part"]
        )

    once = parts.repartition(_BLOCKS, "block", "salt").mapInArrow(add, _PARTS)
    rows = once.repartition(max(1, _BLOCKS // 8), "block").mapInArrow(add, _PARTS).collect()
    if not rows:  # no partition had a row
        return np.zeros(size, dtype=np.float32)
    return np.concatenate([np.frombuffer(r.part, dtype=np.float32) for r in sorted(rows, key=lambda r: r.block)])


def _blocks_of(m: np.ndarray, salt: int) -> pa.RecordBatch:
    parts = np.split(np.ascontiguousarray(m.reshape(-1), dtype=np.float32), _BLOCKS)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(_BLOCKS), pa.int32()), pa.array([salt] * _BLOCKS, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "salt", "part"]
    )


_PARTS = "block int, salt int, part binary"


def _salt() -> int:
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() if TaskContext.get() else 0) % 32


def document_frequencies(ids: DataFrame) -> np.ndarray:
    """Documents that hold each hashed term, over the whole corpus; TERMS numbers come to the driver."""
    own = ids.select(F.explode(F.array_distinct("ids")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    total = np.zeros(TERMS)
    for r in own.collect():  # TERMS rows at most
        total[r.t] = r.n
    return total


def latent_space(ids: DataFrame, own: list[np.ndarray], turns: int = 2, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(idf, basis): randomised SVD of the TF-IDF windows of the corpus and of the items, of equal weight.

    Each turn adds up A'(A q) over the partitions (TERMS x RANK numbers) and makes q orthonormal; the
    items count as much as the corpus, so that the space holds their words, rare as they are there.
    """
    n = max(1, ids.count())
    idf = np.log1p(n / (1.0 + document_frequencies(ids)))
    sc = ids.sparkSession.sparkContext
    v = Vectors(idf)
    mine = [v.windows(x, ITEM_STEP) for x in own if len(x)]
    q = np.random.default_rng(seed).standard_normal((TERMS, RANK)).astype(np.float32)
    for _ in range(turns):
        shared = sc.broadcast((idf.astype(np.float32), q))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            idf, q = shared.value
            v, total = Vectors(idf), np.zeros((TERMS, RANK), dtype=np.float32)
            for docs in _lists(batches):
                got = [v.windows(x, WINDOW) for x in docs]
                if got:
                    _gram(np.concatenate([t for t, _ in got]), np.concatenate([w for _, w in got]), q, total)
            yield _blocks_of(total, _salt())

        y = _sum_blocks(_gathered(ids).mapInArrow(run, _PARTS), TERMS * RANK).reshape(TERMS, RANK).astype(np.float64)
        e = np.zeros((TERMS, RANK), dtype=np.float32)
        for t, w in mine:
            _gram(t, w, q, e)
        y = y / max(1e-9, np.linalg.norm(y)) + e / max(1e-9, np.linalg.norm(e))
        q = np.linalg.qr(y)[0].astype(np.float32)
    return idf, q


# ---------------------------------------------------------------------------------------------
# exact check


class Item:
    def __init__(self, item_id: int, text: str, answer: str | None):
        self.item_id = item_id
        self.answer = answer
        body, self.closing = passage(text)
        self.words = words(body)
        self.solid = bool(_SOLID.search(body))
        self.bounds: list[tuple[int, int]] = []
        if self.solid:
            at = 0
            for a, b in sentences.fitted().units(body):
                n = len(words(body[a:b]))
                self.bounds.append((at, at + n))
                at += n
        self.places: dict[str, list[int]] = {}
        for i, w in enumerate(self.words):
            self.places.setdefault(w, []).append(i)


def _runs(item: Item, doc: list[str]) -> list[tuple[int, int, int]]:
    """Maximal common runs (start in item, start in document, length)."""
    live: dict[int, int] = {}
    out = []
    for j, w in enumerate(doc):
        now: dict[int, int] = {}
        for i in item.places.get(w, ()):
            now[i] = live.pop(i - 1, 0) + 1
        for i, n in live.items():
            out.append((i - n + 1, j - n, n))
        live = now
    out += [(i - n + 1, len(doc) - n, n) for i, n in live.items()]
    return out


def leaked(item: Item, doc: list[str]) -> tuple[int, int] | None:
    """(words of the passage covered, changed) of the longest leak in the document, or None.

    Runs of common words are chained in order; what lies between two runs counts as changed. Of all
    chains the best is found by dynamic programming: for each run and number of changed words, the
    first word of the passage from which a chain reaches the end of the run. Where at most one word in
    CHANGED is changed, some run has six words or more (five in a unit of a script without spaces, of
    ten words or more), and no run of the chain is farther from its diagonal than words are changed.
    """
    runs = _runs(item, doc)
    least = 5 if item.solid else min(6, LEAST)
    most = max((q - p for p, q in item.bounds), default=0) if item.solid else len(item.words)
    cap = most // CHANGED
    strong = {i - j for i, j, n in runs if n >= least}
    if not strong:
        return None
    band = {d + e for d in strong for e in range(-cap, cap + 1)}
    near = sorted((i + n, i, j, n) for i, j, n in runs if i - j in band)
    best = None
    firsts: list[list[int]] = []
    for b, (x1, i, j, n) in enumerate(near):
        first = [i] + [x1] * cap
        for a in range(b - 1, -1, -1):
            end, i0, j0, n0 = near[a]
            if i - end > cap:
                break
            di, dj = i - end, j - j0 - n0
            late = max(0, -di, -dj)  # words of this run that the one before has taken
            if late >= n:
                continue
            gap = max(di, dj) + late
            for c in range(cap + 1 - gap):
                if firsts[a][c] < first[c + gap]:
                    first[c + gap] = firsts[a][c]
        firsts.append(first)
        for c, x0 in enumerate(first):
            size = x1 - x0
            if item.solid:
                for p, q in item.bounds:
                    miss = max(0, x0 - p) + max(0, q - x1)
                    if q - p >= 6 and x0 < q and x1 > p and (c + miss) * CHANGED <= q - p:
                        best = max(best or (0, 0), (q - p, -c))
            elif size >= LEAST and c * CHANGED <= size:
                best = max(best or (0, 0), (size, -c))
    return (best[0], -best[1]) if best else None


# ---------------------------------------------------------------------------------------------

RESULT = "doc_id bigint, item_id bigint, coseno double, palabras int, cambiadas int, respuesta boolean"


def items_of(items: DataFrame) -> list[Item]:
    """The fixed set of evaluation items, without null and blank ones; a repeated id keeps each text."""
    rows = items.select("item_id", "text", "respuesta").distinct().collect()
    return [x for x in (Item(r.item_id, r.text, r.respuesta) for r in rows if r.text and r.text.strip()) if x.words]


def leak_report(documents: DataFrame, items: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Documents that hold a passage of an item, whole, in part or slightly altered.

    -> (doc_id, item_id, coseno, palabras, cambiadas, respuesta). Candidates are all windows of all
    documents whose cosine to a window of an item in the latent space reaches ``cosine``; an alignment
    of common runs decides. ``respuesta`` tells whether the item's answer stands in the document too.
    The closing question of an item counts for nothing. Null and empty texts on either side give no
    row; repeated documents give their rows once. The items, a stated query set, come to the
    driver and are broadcast in blocks of ITEM_BLOCK; documents never are.
    """
    spark = documents.sparkSession
    ship(spark)
    own = items_of(items)
    if not own:
        return spark.createDataFrame([], RESULT)
    corpus = hashed(documents)
    v = Vectors(np.ones(TERMS))
    idf, basis = latent_space(corpus, [v.ids(x.words) for x in own])
    v = Vectors(idf)
    found_ = [_search(corpus, own[i : i + ITEM_BLOCK], v, idf, basis, cosine) for i in range(0, len(own), ITEM_BLOCK)]
    return reduce(DataFrame.unionByName, found_)


def _search(corpus: DataFrame, block: list[Item], v: Vectors, idf: np.ndarray, basis: np.ndarray, cosine: float) -> DataFrame:
    """All documents against one block of items, whose window vectors are broadcast."""
    spark = corpus.sparkSession
    rows, of = [], []
    for k, x in enumerate(block):
        z = _project(*v.windows(v.ids(x.words), ITEM_STEP), basis)
        rows.append(z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9))
        of.append(np.full(len(z), k))
    queries, of_item = np.concatenate(rows).astype(np.float32), np.concatenate(of)
    shared = spark.sparkContext.broadcast(((idf[:, None] * basis).astype(np.float32), queries, np.flatnonzero(np.diff(of_item, prepend=-1)), block, *_owners([v.ids(x.words) for x in block])))

    names = ("doc_id", "item_id", "coseno", "palabras", "cambiadas", "respuesta")
    kind = dict(corpus.dtypes)["doc_id"]
    schema = RESULT.replace("doc_id bigint", f"doc_id {kind}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted, queries, starts, block, keys, owners = shared.value
        for b in batches:
            out: dict[str, list] = {k: [] for k in names}
            doc_ids, texts = b.column(0).to_pylist(), b.column(1)
            for lo, ids in _chunks(b.column(2)):
                z, first, live = _latent(ids, weighted)
                if not len(live):
                    continue
                best = np.concatenate([np.maximum.reduceat(z[i : i + 2048] @ queries.T, starts, axis=1) for i in range(0, len(z), 2048)])
                best = np.maximum.reduceat(best, first, axis=0)
                best[~_share([ids[i] for i in live], keys, owners, len(block))] = -1.0
                read: dict[int, list[str]] = {}
                for a, k in zip(*np.nonzero(best >= cosine)):
                    x, at = block[k], lo + int(live[a])
                    if at not in read:
                        read[at] = words(texts[at].as_py())
                    ws = read[at]
                    if hit := leaked(x, ws):
                        answer = words(x.answer) if x.answer else []
                        told = bool(answer) and f" {' '.join(answer)} " in f" {' '.join(ws)} "
                        for name, value in zip(names, (doc_ids[at], x.item_id, float(best[a, k]), hit[0], hit[1], told)):
                            out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in zip(names, types)], names=list(names))

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in spark.createDataFrame([], schema).schema.fields]
    return corpus.select("doc_id", "text", "ids").mapInArrow(run, schema)


def _triples(ids: np.ndarray) -> np.ndarray:
    """A number for each three hashed terms in a row."""
    x = ids.astype(np.uint64)
    return x[:-2] * np.uint64(TERMS * TERMS) + x[1:-1] * np.uint64(TERMS) + x[2:] if len(x) > 2 else np.zeros(0, np.uint64)


def _owners(items: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted triples of all items, and the items that hold each."""
    pairs = [(t, np.full(len(t), k)) for k, t in ((k, np.unique(_triples(x))) for k, x in enumerate(items))]
    flat, of = np.concatenate([t for t, _ in pairs]), np.concatenate([k for _, k in pairs])
    order = np.argsort(flat, kind="stable")
    keys, starts = np.unique(flat[order], return_index=True)
    return keys, np.split(of[order], starts[1:])


def _share(docs: list[np.ndarray], keys: np.ndarray, owners: list[np.ndarray], n: int) -> np.ndarray:
    """Which items have three terms in a row in common with each text: without them there is no run that a leak needs."""
    out = np.zeros((len(docs), n), dtype=bool)
    if not len(keys):
        return out
    triples = [_triples(x) for x in docs]
    flat, of = np.concatenate(triples), np.repeat(np.arange(len(docs)), [len(t) for t in triples])
    at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
    for i in np.flatnonzero(keys[at] == flat):
        out[of[i], owners[at[i]]] = True
    return out


def _chunks(column: pa.Array, words_: int = 60_000) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, hashed terms of each row) of runs of rows with about ``words_`` words; a longer text is a run of its own."""
    ends = np.cumsum(np.asarray(column.value_lengths(), dtype=np.int64))
    lists = np.split(np.asarray(column.flatten(), dtype=np.int64), ends[:-1]) if len(ends) else []
    lo = 0
    while lo < len(lists):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + words_, side="right")))
        yield lo, lists[lo:hi]
        lo = hi


def _latent(ids: list[np.ndarray], weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors of the windows, first window of each text, texts that have any): a window's vector is the
    difference of two running sums of its terms' weighted rows; its length falls out with the unit length."""
    sizes = np.array([len(x) for x in ids])
    live = np.flatnonzero(sizes >= 6)
    if not len(live):
        return np.zeros((0, weighted.shape[1]), np.float32), live, live
    rows = weighted[np.concatenate([ids[i] for i in live])]
    sums = np.zeros((len(rows) + 1, rows.shape[1]))
    np.cumsum(rows, axis=0, dtype=np.float64, out=sums[1:])
    begin, stop, first, at = [], [], [], 0
    base = 0
    for n in sizes[live].tolist():
        s = np.minimum(np.arange(0, max(1, n - WINDOW + STEP), STEP), max(0, n - WINDOW))
        first.append(at)
        begin.append(s + base)
        stop.append(s + base + min(WINDOW, n))
        at, base = at + len(s), base + n
    z = (sums[np.concatenate(stop)] - sums[np.concatenate(begin)]).astype(np.float32)
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    return z, np.array(first), live


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """p8_found: (doc_id, item_id)."""
    return leak_report(documents, items).select("doc_id", "item_id").distinct()


def leaked_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document with leaks: (doc_id, items, palabras) with the sorted items and the longest leak."""
    r = leak_report(documents, items).distinct()
    return r.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("palabras").alias("palabras"))
