import random

import pytest
from pyspark.sql import functions as F

from riverloom.llm import budget, tokens
from riverloom.llm.common import tokenizer_bytes

tokenizers = pytest.importorskip("tokenizers")
TEXTS = [
    "Hola, ¿qué tal?\n\n  Dos  espacios\ttab", "", None, "don't we'll I'm 'tis", "数据实验室 確認した。 12345 ½ ²", " nbsp　wide    line", "a" * 5000 + " b" * 3000, "emoji 👩🏽‍🔬 x​ý", "   ", "\r\n\r\n x",
]


def reference():
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("hot", [0, 3, 8192])
def test_encode_equals_tokenizer_and_decodes(spark, hot):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "again"), (None, "sin id", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3)
    enc = tokens.encode_corpus(df, hot_words=hot)
    got = {r.doc_id: r.ids for r in enc.collect()}
    assert enc.count() == len(TEXTS) + 1
    ref = reference()
    for i, t in enumerate(TEXTS):
        assert got[i] == ref.encode(t or "", add_special_tokens=False).ids
    back = {r.doc_id: r.text for r in tokens.decode_corpus(enc).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS))


def test_same_id_other_text(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b c")], "doc_id bigint, text string")
    assert sorted(len(r.ids) for r in tokens.encode_corpus(df).collect()) == [1, 2]
    assert tokens.encode_corpus(df.limit(0)).count() == 0


def test_longest_match_equals_brute_force():
    rng = random.Random(2)
    vocab = [bytes([b]) for b in b"abc "] + [bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(30)]
    m = tokens.LongestMatch(vocab)
    known = set(vocab)
    for _ in range(400):
        s = bytes(rng.choices(b"abc ", k=rng.randint(0, 30)))
        n = i = 0
        while i < len(s):
            i += max(k for k in range(1, 6) if s[i : i + k] in known and i + k <= len(s))
            n += 1
        assert m.count(s) == n


def test_pieces_count_as_the_whole_text():
    memo = tokens._memo(tokenizer_bytes("byte_bpe_50k.tiktoken"))
    for t in TEXTS:
        if t and len(t) < 200:
            assert tokens.count_longest(t, memo) == memo.matcher.count(t.encode())


def test_estimates(spark):
    rows = [("a", "x" * 100, 50), ("b", "x" * 10, 10), ("c", "x" * 200, 10), ("d", "texto", None), ("e", "texto", 0), ("f", "texto", -2), ("g", None, None), ("h", "  ", 0), ("a", "x" * 100, 50)]
    df = spark.createDataFrame(rows, "chunk_id string, texto string, num_tokens int").withColumn("tokens", F.lit(1))
    got = {r.chunk_id: r.motivo for r in tokens.token_estimates(df).collect()}
    assert got == {"a": None, "b": "pocos_puntos", "c": "muchos_puntos", "d": "nulo", "e": "no_positivo", "f": "no_positivo", "g": None, "h": None}
    assert sorted(r.chunk_id for r in tokens.unusable_counts(df).collect()) == ["b", "c", "d", "e", "f"]
    assert tokens.unusable_counts(df.limit(0)).count() == 0


def test_totals(spark):
    t = "La oficina revisó los datos del puerto y la comisión confirmó el plan de la ciudad."
    rows = [("d1", "c1", "Boletín_1.pdf", ".PDF", 1, 20, t, "es"), ("d1", "c2", "BoletÃ\xadn_1.pdf", "pdf", 1, 20, t, None), ("d1", "c3", None, "pdf", None, 0, t, "xx"), ("d2", "c4", "", "html", 2, 5, None, None)]
    df = spark.createDataFrame(rows, "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, num_tokens int, texto string, idioma string")
    got = {(r.corte, r.valor): (r.fragmentos, r.inservibles) for r in budget.totals(df).collect()}
    assert got["fuente", "Boletín_1.pdf"] == (3, 1) and got["fuente", None] == (1, 0)
    assert got["formato", "pdf"] == (3, 1) and got["idioma", "es"] == (3, 1) and got["todo", "todo"] == (4, 1)
