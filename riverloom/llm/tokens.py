"""Problems 6 and 7: token budgets by longest match, and exact encoding by a global word dictionary."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import cut, map_columns, tokenizer_bytes

# The public pre-token pattern of byte_bpe_50k, white space spelled out because
# Java's \s is ASCII only.
_WS = r"\t-\r \x85\xA0  -     　"
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}]+|[" + _WS + r"]+(?![^" + _WS + r"])|[" + _WS + r"]+"
)
#: Words that are joined by broadcast: at most so many, each of at most so many characters, so the
#: table stays under HOT_WORDS * (4 * HOT_CHARS bytes of text + as many ids) whatever the corpus.
HOT_WORDS, HOT_CHARS = 8192, 24


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


@lru_cache(2)
def _encoder(raw: bytes):
    import tiktoken

    # one pre-token at a time: the pattern takes the whole string
    return tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=parse_ranks(raw), special_tokens={})


def _word_ids(words: DataFrame, tokenizer_dir: str | None) -> DataFrame:
    ship(words.sparkSession)
    raw = words.sparkSession.sparkContext.broadcast(tokenizer_bytes("byte_bpe_50k.tiktoken", tokenizer_dir))
    schema = "word string, n long, ids array<int>"
    kind = pa.schema([("word", pa.string()), ("n", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(raw.value)
        for b in batches:
            ids = [enc.encode_ordinary(w) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, type=kind.field(2).type)], schema=kind)

    return words.select("word", "n").mapInArrow(run, schema)


def encode_corpus(documents: DataFrame, tokenizer_dir: str | None = None, hot_words: int = HOT_WORDS) -> DataFrame:
    """Ids of every document by byte_bpe_50k, without special tokens -> (doc_id, ids).

    Each distinct word of the corpus is encoded once. The bounded set of the most frequent words is
    broadcast and takes its places in each document at once, so that words that occur in every document
    neither skew the shuffle nor swell it: a document is one row of ids with gaps. The other pre-tokens are
    exploded with the number of their gap, joined by shuffle and put into the gaps by position.

    Null and empty texts give an empty list. Rows equal in doc_id and text give one row; rows that
    share a doc_id but not the text give one row each. A null doc_id is kept. Other columns are
    ignored. An empty table gives an empty result.
    """
    rows = documents.select(
        F.col("doc_id"), F.xxhash64("text").alias("_h"), F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(PRETOKEN), F.lit(0)).alias("_w")
    )
    words = rows.select(F.explode(F.array_distinct("_w")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    table = cut(_word_ids(words, tokenizer_dir))
    hot = (
        table.where(F.length("word") <= HOT_CHARS).orderBy(F.desc("n"), "word").limit(hot_words).select("word", F.col("ids").alias("hot_ids"))
    )
    shared = documents.sparkSession.sparkContext.broadcast({r.word: list(r.hot_ids) for r in hot.collect()})  # hot_words rows at most
    kind = dict(documents.dtypes)["doc_id"]
    packed = rows.mapInArrow(_packer(shared), f"doc_id {kind}, _h long, ids array<int>, words array<string>")
    rare = packed.select("doc_id", "_h", F.posexplode("words").alias("k", "word")).join(table.select("word", "ids"), "word")
    none = F.lit(None)
    parts = packed.select("doc_id", "_h", F.col("ids").alias("base"), none.cast("int").alias("k"), none.cast("array<int>").alias("ids"))
    parts = parts.unionByName(rare.select("doc_id", "_h", none.cast("array<int>").alias("base"), "k", "ids"))
    # repeats of a row repeat its gaps; a sorted list drops them
    filled = F.array_distinct(F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "ids")))))
    whole = parts.groupBy("doc_id", "_h").agg(F.first("base", ignorenulls=True).alias("base"), F.transform(filled, lambda x: x["ids"]).alias("gaps"))
    return whole.select("doc_id", "base", "gaps").mapInArrow(_fill, f"doc_id {kind}, ids array<int>")


#: Stands in a document's ids for a word that is joined later.
GAP = -1


def _packer(shared):
    """Ids of the frequent words of each document, GAP for the others, and those as a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        gap = [GAP]
        for b in batches:
            ids, rest = [], []
            for ws in b.column(2).to_pylist():
                got = [hot.get(w, gap) for w in ws]
                rest.append([w for w, g in zip(ws, got) if g is gap])
                ids.append([i for g in got for i in g])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.list_(pa.int32())), pa.array(rest, pa.list_(pa.string()))], names=["doc_id", "_h", "ids", "words"])

    return run


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gaps of each document replaced by the ids of its other words, in order."""
    for b in batches:
        out = []
        for base, gaps in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            if gaps:
                more = iter(gaps)
                ids: list[int] = []
                for i in base:
                    if i == GAP:
                        ids += next(more)
                    else:
                        ids.append(i)
                base = ids
            out.append(base)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=["doc_id", "ids"])


def decode_corpus(encoded: DataFrame, tokenizer_dir: str | None = None) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text) through the token-byte table, a bounded broadcast of 50,256 rows.

    An empty list gives an empty text; a null list gives null.
    """
    spark = encoded.sparkSession
    ranks = parse_ranks(tokenizer_bytes("byte_bpe_50k.tiktoken", tokenizer_dir))
    table = spark.createDataFrame([(i, bytearray(b)) for b, i in ranks.items()], "id int, bytes binary")
    rows = encoded.select("doc_id", F.xxhash64("ids").alias("_h"), F.col("ids").isNull().alias("_null"), F.posexplode_outer("ids").alias("pos", "id"))
    joined = rows.join(F.broadcast(table), "id", "left")
    parts = joined.groupBy("doc_id", "_h", "_null").agg(F.collect_list(F.struct("pos", "bytes")).alias("p"))
    ordered = F.array_distinct(F.array_sort(F.filter("p", lambda x: x["pos"].isNotNull())))
    text = F.decode(F.unhex(F.array_join(F.transform(ordered, lambda x: F.hex(x["bytes"])), "")), "UTF-8")
    return parts.select("doc_id", F.when(~F.col("_null"), text).alias("text"))


# ---------------------------------------------------------------------------------------------
# longest match


class LongestMatch:
    """Counts tokens of greedy longest match in linear time over a byte trie with failure links.

    Every node holds the number of tokens that are emitted when the walk can't go on from it, and
    the node that the rest of the string leads to. All 256 single bytes must be in the vocabulary.
    """

    def __init__(self, vocabulary):
        goto: dict[int, int] = {}
        token = [False]
        parent_order = []
        for t in vocabulary:
            u = 0
            for c in t:
                v = goto.get(u << 8 | c)
                if v is None:
                    v = len(token)
                    goto[u << 8 | c] = v
                    token.append(False)
                    parent_order.append((u, c, v))
                u = v
            token[u] = True
        depth = [0] * len(token)
        for u, _, v in parent_order:  # a parent is numbered before its children
            depth[v] = depth[u] + 1
        fail, out = [-1] * len(token), [0] * len(token)
        for u, c, v in sorted(parent_order, key=lambda x: depth[x[2]]):
            if token[v]:
                fail[v], out[v] = 0, 1
                continue
            z, n = fail[u], out[u]
            while z >= 0 and (z << 8 | c) not in goto:
                n += out[z]
                z = fail[z]
            if z >= 0:
                fail[v], out[v] = goto[z << 8 | c], n
        self.goto, self.fail, self.out = goto, fail, out

    def count(self, data: bytes) -> int:
        goto, fail, out = self.goto, self.fail, self.out
        u = n = 0
        for c in data:
            while (v := goto.get(u << 8 | c)) is None:
                n += out[u]
                u = fail[u]
            u = v
        while u > 0:
            n += out[u]
            u = fail[u]
        return n


class _Memo(dict):
    """Counts by piece; emptied when full, which changes no count."""

    def __init__(self, matcher: LongestMatch, most: int = 200_000):
        super().__init__()
        self.matcher, self.most = matcher, most

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        n = self[piece] = self.matcher.count(piece.encode("utf-8", "surrogatepass"))
        return n


_PIECE = re.compile(r" ?[^ ]+| +(?= [^ ])| +")


@lru_cache(1)
def _memo(raw: bytes) -> _Memo:
    return _Memo(LongestMatch(parse_ranks(raw)))


def count_longest(text: str, memo: _Memo) -> int:
    """No token of the vocabulary spans a word and the space after it, so pieces count by themselves."""
    return sum(map(memo.__getitem__, _PIECE.findall(text)))


ESTIMATE = "chunk_id string, puntos int, num_tokens int, tokens int, motivo string"


def token_estimates(fragments: DataFrame, tokenizer_dir: str | None = None, least: float = 1.5, most: float = 12.0) -> DataFrame:
    """Token estimate of each distinct fragment, and why its recorded count can't enter a budget.

    -> (chunk_id, puntos, num_tokens, tokens, motivo). ``puntos`` are code points; ``tokens`` is the
    exact number of longest-match tokens over the byte_bpe_50k vocabulary; ``motivo`` is null for a
    usable record, else ``nulo``, ``no_positivo``, ``pocos_puntos`` or ``muchos_puntos`` (fewer than
    ``least`` or more than ``most`` code points a token). Null and blank texts have 0 tokens and a
    null motivo. Repeats of a fragment that differ in other columns give one row.
    """
    raw = fragments.sparkSession.sparkContext.broadcast(tokenizer_bytes("byte_bpe_50k.tiktoken", tokenizer_dir))

    def run(d: dict[str, list]) -> dict[str, list]:
        memo = _memo(raw.value)
        points, counts, why = [], [], []
        for t, n in zip(d["texto"], d["num_tokens"]):
            if t is None or not t.strip():
                points.append(0 if t is None else len(t)), counts.append(0), why.append(None)
                continue
            points.append(len(t))
            counts.append(count_longest(t, memo))
            if n is None:
                why.append("nulo")
            elif n <= 0:
                why.append("no_positivo")
            elif len(t) / n < least:
                why.append("pocos_puntos")
            elif len(t) / n > most:
                why.append("muchos_puntos")
            else:
                why.append(None)
        return {"chunk_id": d["chunk_id"], "puntos": points, "num_tokens": d["num_tokens"], "tokens": counts, "motivo": why}

    rows = map_columns(fragments, ["chunk_id", "texto", "num_tokens"], ESTIMATE, run)
    return rows.distinct()


def unusable_counts(fragments: DataFrame, tokenizer_dir: str | None = None) -> DataFrame:
    """p6_found: fragments whose recorded count can't enter a budget -> (chunk_id)."""
    return token_estimates(fragments, tokenizer_dir).where(F.col("motivo").isNotNull()).select("chunk_id").distinct()
