"""Behavioural constants of retrieval, graph and map jobs, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# Function and framing words that name no entity.
STOPWORDS = frozenset(
    """a al ante como con contra cual cuales cuando cuanto de del desde donde dos e el ella ellas ellos en entre era es esa ese eso esta estan este esto estos
    ha han hasta hay la las le les lo los mas me mi mismo mucho muy no o os otra otro para pero poco por porque que quee quien se segun ser si sin sobre son su sus
    tal tan te tiene todo todos tras un una uno unos y ya
    an and are as at be but by can do does for from has have how in is it its of on or that the their them there these they this to was were what when where which
    who why will with das em nao num numa ou pelo pela sao uma
    cómo qué cuál cuáles manera forma principales recientes actualmente existen representan implica implican""".split()
)
# Verbs that name a relation, third person singular and plural.
RELATION_VERBS = """desarrolla regula opera acuerda ataca amenaza emplea utiliza financia controla afecta genera produce implementa expande combate coopera firma lanza
monitorea detecta intercepta vulnera disputa explota""".split()
DEFAULT_RELATION = "relacionado_con"
# Articles that may precede an entity in a question.
ARTICLES = ("el", "la", "los", "las", "un", "una", "unos", "unas", "the", "a", "an")
# Endings after which a full stop doesn't close a sentence.
ABBREVIATIONS = r"\b(?:ee\.?\s?uu|ee|uu|dr|dra|sr|sra|ing|prof|fig|no|núm|num|vol|pág|pag|art|aprox|etc|ca|cf|vs|op|cit|u\.s|u\.k|st|mr|mrs|ms|jr)\.$"


@dataclass(frozen=True)
class Retrieval:
    top_k: int = 200
    second_top_k: int = 100
    graph_candidates: int = 100
    refine: int = 60
    fragments: int = 10
    documents: int = 3
    per_document: int = 5
    max_words: int = 250
    kept_share: float = 0.6
    graph_weight: float = 0.5
    document_bonus: float = 0.30
    z_epsilon: float = 1e-9


@dataclass(frozen=True)
class Graph:
    max_ngram: int = 6
    min_chars: int = 4
    df_max_share: float = 0.02
    df_saturation: int = 5
    df_informative: int = 2000
    df_max_neighbour: int = 200
    neighbour_weight: float = 0.15
    neighbours: int = 25
    coverage_bonus: float = 0.40
    phrase_bonus: float = 0.25
    min_score: float = 0.55
    min_length: int = 2
    min_text: int = 10
    min_node: int = 3
    evidence: int = 10


RETRIEVAL, GRAPH = Retrieval(), Graph()
