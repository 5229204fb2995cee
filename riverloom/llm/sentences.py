"""Problem 9: sentence units across languages and scripts."""

from __future__ import annotations

import random
import re
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import map_columns

# ---------------------------------------------------------------------------------------------
# training text: sentences whose units are known; they are joined in many ways to fit the tagger

_SENTENCES = {
    "es": """La oficina revisó los datos del puerto.|¿Quién responde por la pérdida del bosque?|¡Nadie examinó la compra!|El Dr. Pérez visitó la Av. Central con 20 hombres.|La Sra. R. T. Lima y el Ing. Soto firmaron el acta núm. 39.
Según el art. 83 del reglamento, la comisión cuestionó el plan.|Participaron delegados de EE. UU. y de Chile, p. ej. técnicos y juristas.|La patrulla llegó a las 2 p. m.|Se llevaron redes, remos, cuerdas, etc.|La tasa pasó de 31,4 a 10,7 por ciento.
La copia quedó en notas.museo44.example y cambia cada año.|La versión 2.93 del sistema falló.|El equipo dudó… pero al final aceptó la propuesta.|La escuela sigue sin recibir noticias…|La escuela sigue sin recibir noticias...|(Compárese la tabla 8.)
«No hay garantías», dijo la vocera de Lima.|—¿Hubo aviso previo? —preguntó el delegado de Quito.|¿Qué pasó en Lima?, se pregunta el comité.|El acta concluye: «La mesa registró el avance.»|La lista incluye: a) la calidad; b) la respuesta; c) la pérdida.|40 familias salieron de Lima en 2012.|Responda con una sola palabra: ¿qué dato permite sostener la conclusión?|Según el texto anterior, ¿cuál de las siguientes afirmaciones es la mejor?|En consecuencia, el Gral. Ríos cruzó el puente.|La obra costó 402.118 dólares, un 7,3 % menos que en 1996.|Además, desde 2001, la red publicó el informe.|Lima cerró el paso en 1999.""",
    "en": """The office reviewed the data of the harbour.|Who is responsible for the loss of forest?|Nobody examined the purchase!|Why not?!|Dr. Lane visited St. Mary bridge with 20 men.|Mr. J. K. Moore and Prof. Hill signed act no. 58.|Under Art. 75 of the rules, the board changed the plan.
Experts from the U.S. and from Chile took part, e.g. lawyers and engineers.|The patrol reached the post at 5 p.m.|They took nets, oars, ropes, etc.|The rate rose from 31.4 to 10.7 percent.|The copy sits at notes.museum44.example and changes every year.|Version 2.85 of the system failed.
The ministry hesitated... but in the end agreed.|The office is still waiting for an answer...|(Compare table 8.)|“We had no warning,” said the delegate from Lima.|“Was there a warning?” asked the envoy from Quito.|The minutes read: “The board recorded the spread.”|The list covers: (a) the quality; (b) the response; (c) the loss.|43 families left Lima in 2012.
The panel (which met in Lima, cf. vol. 50, pp. 3-73) reviewed the trade.|The budget was $63,444, or 6.4% more than in 2008.|Gen. Hale crossed the river.|According to the passage above, which of the following statements is the best?|Moreover, since 2001, the network published the report.|"We had no warning," said the clerk.|Lima shut the crossing in 1999.""",
    "pt": """A prefeitura revisou os dados do porto.|Quem explica os riscos da automação?|Ninguém questionou a compra!|O Dr. Souza visitou a Av. Central com 20 homens.|A Sra. L. F. Lima e o Prof. Melo assinaram a ata nº 39.|Conforme o art. 85 do regulamento, o conselho mudou o plano.|Participaram delegados dos EUA e do Chile, p. ex. técnicos e juristas.
A patrulha chegou às 17 h.|Levaram redes, remos, cordas, etc.|A taxa passou de 33,6 para 42,3 por cento.|A cópia ficou em notas.museu44.example e muda todo ano.|A versão 2.93 do sistema falhou.|O ministério hesitou… mas no fim aceitou.|A equipe ainda espera uma resposta...|(Confira a tabela 8.)
“Não há garantias”, disse a porta-voz de Lima.|A faixa dizia «NÃO HÁ AMANHÃ» em Lima.|A ata conclui: “A associação registrou o avanço.”|12 famílias saíram de Lima em 2008.|A obra custou R$ 402.118, 7,3 % a menos que em 1996.|Além disso, desde 2001, a rede publicou o relatório.""",
    "fr": """La mairie a vérifié les données du port.|Qui surveille les pannes du réseau ?|Personne ne répond à Lima !|Le Dr Blanc a visité l’av. Centrale avec 20 hommes.|M. Roux et le Pr. Petit attendent encore…|Mme Roux et le Pr. Petit ont signé.|Selon l’art. 83 du règlement, la commission a changé le plan.
La copie se trouve à notes.musee44.example depuis 1996.|Le chantier a coûté 402 118 euros, soit 7,3 % de moins qu’en 1996.|Le ministère a hésité… mais a fini par accepter.|(Comparer au tableau 8.)|« Rien n’est garanti », affirme la porte-parole de Lima.|Le procès-verbal conclut : « La commission a relevé le recul. »
13 familles ont quitté Lima en 2008.|On parle d’un cadre politico-militaire.|Des experts sont venus, p. ex. des juristes, des pêcheurs, etc.|En outre, depuis 2001, le réseau a publié le bilan.|D’après le passage ci-dessus, laquelle des affirmations est la mieux étayée ?""",
    "de": """Die Verwaltung prüfte die Daten des Hafens.|Wer haftet für die Folgen?|Niemand prüfte den Mangel!|Dr. Weiß kam um 8.30 Uhr nach Lima.|Prof. Dr. Klein kam nach Kiel.|Viele Geräte, z. B. Sensoren und Pumpen, fehlten.|Am 10. Mai 2014 bestätigte der Verband den Handel.|Gemäß Art. 83 der Satzung beschloss der Rat den Plan.
Der Verband zögerte … doch dann kam die Antwort.|(Vergleiche Tafel 8.)|„Es gibt keine Gewähr“, sagte die Sprecherin von Kiel.|Das Protokoll schließt: „Der Rat erfasste den Verlust.“|26 Familien verließen Kiel im Jahr 2003.|Der Anteil sank von 61,5 auf 40,8 Prozent seit 2009.|Laut Bericht beschrieb das Ministerium den Abbau.|Man sprach über den Plan, d. h. über Geld usw.|Am 3. Juni begann die Arbeit.|Vom 1. Januar bis zum 2. März war Pause.""",
    "ru": """Отдел проверил данные порта.|Кто отвечает за потерю леса?|Никто не пришёл!|В 2003 г. совет отметил нехватку специалистов.|Цена упала с 61,5 до 40,8 рубля, т. е. на треть.|Изъяли моторы, насосы и т. д.|«Дорога закрыта», — сказал водитель автобуса.|(См. приложение 21.)|Комиссия потратила 5 тыс. рублей на ремонт.|В 2011 году центр описал торговлю.
В протоколе сказано: «Совет изучил торговлю.»|Несмотря на дожди союз рыбаков вышел на работу.|Проф. А. Б. Иванов и др. подписали акт № 39.|Совет колебался… но затем согласился.|Кроме того, институт описал пути.|См. рис. 5 и табл. 3 на с. 12.""",
    "zh": """办公室审查了港口的数据。|谁应对森林的消失负责？|没有人回应！|“道路已经封了。”司机说。|“怎么了？”司机问道，“路上没有人。”|会议记录写道：“委员会记录了扩张。”|监测中心犹豫了……但最终同意了计划。|比例从31.4%升至10.7%。|35户家庭于2003年离开。|据10份证词，观察站指出了问题。|（见附件21。）|“这是错误的！”老师喊道。|“我们明天再来。”她说道。|会议记录写道：“实验室质疑了故障。”|“太晚了！”居民回答。|“谁来负责？”记者问道，“没有人知道。”""",
    "ja": """事務局は港のデータを調べた。|誰が森林の減少の責任を負うのか？|本当なのか！？|誰も来なかった！|「道は閉まっています。」と運転手は話した。|漁業組合は迷ったが……結局計画に同意した。|割合は31.4%から10.7%に上がった。|35世帯が2003年に去った。|議事録には「委員会は拡大を記録した。」とある。|（付録21を参照。）|報告書によれば、観測所は問題を説明した。""",
    "ar": """راجع المكتب بيانات الميناء.|من المسؤول عن تراجع الغابات؟|لم يأت أحد!|«الطريق مغلق»، قال سائق الحافلة.|قال د. سالم إن النسبة ارتفعت من 31.4 إلى 10.7 في المئة.|قال د. كريم إن العمل بدأ.|رغم الأمطار، درس المجلس الطرق.|غادرت 35 عائلة القرية في عام 2003.|تردد المركز… لكنه وافق في النهاية.|(انظر الملحق 21.)""",
    "hi": """कार्यालय ने बंदरगाह के आँकड़ों की जाँच की।|वन की कटाई के लिए कौन ज़िम्मेदार है?|किसी ने जवाब नहीं दिया!|“रास्ता बंद है”, चालक ने कहा।|डॉ. शर्मा ने गाँव का दौरा किया।|कीमत 61.5 से घटकर 40.8 रुपये हो गई।|2003 में 35 परिवार चले गए।|केंद्र हिचकिचाया… लेकिन अंत में मान गया।|(अनुलग्नक 21 देखें।)|इसके अलावा, परिषद ने समीक्षा की.|मंत्रालय ने खनन की पुष्टि की.""",
    "th": """สำนักงานตรวจสอบข้อมูลของท่าเรือ|ไม่มีใครมา!|ใครต้องรับผิดชอบต่อการสูญเสียป่า?|ราคาลดจาก 61.5 เป็น 40.8 บาท|ทีมภาคสนามบันทึกการค้าใน 54 หมู่บ้าน|หอสังเกตการณ์ยืนยันการสูญเสียหลังทำงาน 92 เดือน|สมาคมชาวประมงวิเคราะห์เส้นทางในปี 2010|นอกจากนี้สภาชุมชนตรวจสอบการค้าโดยไม่ปรึกษาชาวบ้าน|อย่างไรก็ตามคณะกรรมการอธิบายการใช้โดรนใกล้แม่น้ำ
ในขณะเดียวกันศูนย์เฝ้าระวังประณามการขยายตัวของเหมืองแม้ฝนตกหนัก|ตามรายงานหน่วยวิเคราะห์ยืนยันการขาดแคลนในปี 2003|คณะกรรมการภูมิภาคบันทึกการค้าตามคำให้การ 12 ปาก|ในปี 2005 สมาคมประมงอธิบายการค้าปรอท|ใน 35 หมู่บ้าน ทีมภาคสนามตรวจสอบการค้า""",
}
_HEADINGS = {
    "es": "Entorno local|Consejos de cierre|Balance del año 1998|Capítulo 12: Vega Alta|Hallazgos en Loma Alta|Introducción|Anexo 3|Apunte breve",
    "en": "Local setting|Closing advice|Overview of 1998|Chapter 12: Green Hill|Findings in Green Hill|Introduction|Annex 3",
    "pt": "Entorno local|Conselhos de fecho|Balanço do ano 1998|Capítulo 12: Vila Alta|Achados em Vila Alta|Introdução",
    "fr": "Cadre local|Conseils|Aperçu 1998|Chapitre 12 : Mont Vert|Constats à Mont Vert|Introduction",
    "de": "Ratschläge|Rückblick 1998|Kapitel 12: Alte Burg|Befunde in Alte Burg|Einleitung|Regionaler Kontext",
    "ru": "Выводы|Раздел 7|Сводка за 1998 год|Введение", "zh": "区域背景|第12章|2003年概要|建议", "ja": "提言|第12章|1998年のまとめ|はじめに",
    "ar": "النصائح|القسم 7|نظرة على عام 1998|مقدمة", "hi": "सुझाव|भाग 7|1998 की झलक|परिचय", "th": "คำแนะนำ|ภาพรวมปี 1998|บทที่ 12|บทนำ",
}

# ---------------------------------------------------------------------------------------------
# candidates: characters that may be the last of a unit; all others are inside

_CLOSE = r"(?:[   ]?[»]|[”’\"')\]）」』〉》])"
_END = re.compile(rf"[.!?…。！？।॥؟．｡]+(?:{_CLOSE})*(?:[.!?…。！？।؟．]+)?|[ \t\r\xa0]*\n\s*|(?<=[฀-๿\d.%]) +(?=[฀-๿\d])")
_SPACE = re.compile(r"\s*")
_AFTER = frozenset(",;:،、，；：")
_SPEECH = re.compile(r"^\s*(?:[^\s。！？，“”「」]{0,8}(?:说|道|问|喊|答)|と(?!も)|とある|って)")
_TOLD = re.compile(r"[说道问答：:][，,]?[“「\"][^“”「」\"]*$")
_TOKEN_BEFORE = re.compile(r"[^\s(«“\"„—]*$")
_WORD_AFTER = re.compile(r"\s*[«“\"„(\[—–-]*\s*([\w’]+)")
_LINE_START = re.compile(r"[^\n]*$")
_TERMINAL = ".!?…。！？।॥؟．｡»”\"')）」』"


def _kind(c: str) -> str:
    if not c:
        return "end"
    if c.isupper():
        return "U"
    if c.islower():
        return "l"
    if c.isdigit():
        return "d"
    o = ord(c)
    if 0xE00 <= o < 0xE80:
        return "th"
    if c.isalpha() or unicodedata.category(c).startswith("M"):
        return "ideo" if o >= 0x3000 else "abj"
    if c in "«“\"„¿¡(「『（‘":
        return "open"
    if c in "—–-":
        return "dash"
    return "o"


def candidates(text: str) -> list[tuple[int, list[str], bool]]:
    """(end offset, features, forced) of every place where a unit may end."""
    out = []
    n = len(text)
    for m in _END.finditer(text):
        s, e = m.start(), m.end()
        got = m[0]
        if got[0] in " \t\r\xa0\n" and "\n" in got:
            if e >= n or s == 0:
                continue
            if got.count("\n") > 1:
                out.append((s, [], True))
                continue
            if s and text[s - 1] in _TERMINAL and out and out[-1][0] == s:
                continue  # the mark before is the candidate
            line = _LINE_START.search(text, max(0, s - 200), s)[0].strip()
            words = line.split()
            if text[e].islower() or len(line) > 60 and text[s - 1] < "\u0e00":  # a line break inside a sentence
                continue
            first = words[0].lower() if words else ""
            nxt = _kind(text[e])
            if nxt in ("open", "dash"):
                w = _WORD_AFTER.match(text, e)
                nxt = "open" + _kind(w[1][0]) if w else nxt
            size = "s" if len(line) <= 20 else "m" if len(line) <= 34 else "l" if len(line) <= 45 else "xl"
            last = line[-1:]
            lastk = "," if last in ",;、，،" else "-" if last in "-‐¬\xad" else ":" if last == ":" else "d" if last.isdigit() else "w"
            caps = sum(w[:1].isupper() for w in words)
            names = "all" if words and caps >= len(words) - 1 and len(words) > 1 else "some" if caps > 1 else "first" if words and words[0][:1].isupper() else "no"
            begin = "start" if out and _SPACE.match(text, out[-1][0]).end() >= s - len(line) - 1 or not text[: s - len(line)].strip() else "mid"
            f = [f"n:{nxt}", f"n:{_kind(text[s - 1])}>{nxt}", f"n:{_kind(text[s - 1])}>{nxt}:{size}", f"n:{size}", f"n:{size}:{begin}", f"n:{size}:{nxt}:{begin}", f"n:last{lastk}:{begin}", f"n:w{min(len(words), 6)}:{begin}:{nxt}", f"n:first={first}:{begin}", f"n:{names}:{size}:{begin}"]
            if len(words) > 1:
                f.append(f"n:lastword={words[-1].lower()}")
            if re.match(r"^\w+ \d+ ?:|^\w+ \d+$|^第?\d+\w", line):
                f.append(f"n:numbered:{begin}")
            out.append((s, f, False))
            continue
        if got[0] == " ":  # Thai
            a, b = text[s - 1], text[e]
            w = re.match(r"[฀-๿]{1,8}", text[e : e + 8])
            nw = w[0] if w else ""
            p = text[max(0, s - 8) : s]
            number = bool(re.search(r"\d$", p))
            f = [f"t:{'d' if a.isdigit() else 'o'}{'d' if b.isdigit() else 'o'}"]
            before = re.search(r"([฀-๿]+) ?[\d.]+$", text[max(0, s - 30) : s])
            if number and not b.isdigit():
                f += [f"t:dn:{nw[:k]}" for k in (3, 5)]
                if before:
                    f += [f"t:dp:{before[1][-k:]}" for k in (2, 4)]
                    f.append(f"t:{before[1][-4:]}|{nw[:4]}")
                begins = re.search(r"(?:^|\s)ใน(?:ปี)? \d+$", text[max(0, s - 16) : s])
                f.append(f"t:adv{bool(begins)}")
            elif not b.isdigit():
                f += ["t:oo"] + [f"t:on:{nw[:k]}" for k in (3, 5)] + [f"t:op:{p[-k:]}" for k in (3, 5)]
                f.append(f"t:unit{bool(re.search(r'\d [฀-๿]{1,10}$', text[max(0, s - 16) : s]))}")
            else:
                f += [f"t:od:{p[-k:]}" for k in (2, 4)]
            out.append((s, f, False))
            continue
        if e < n and text[e] == "“" and text.rfind("„", 0, e) > text.rfind("“", 0, e):  # closes a „
            e += 1
            got = text[s:e]
        after = text[e] if e < n else ""
        if after in _AFTER and after:
            continue
        mark = got.rstrip("»”“’\"')]）」』〉》   ") or got
        closer = got[len(mark) :].strip()
        spaced = after == "" or after.isspace()
        gap = _SPACE.match(text, e).end()
        if gap >= n:
            out.append((e, [], True))
            continue
        breaks = text[e:gap].count("\n")
        if breaks > 1:
            out.append((e, [], True))
            continue
        nxt = _kind(text[gap])
        if mark[0] == "." and len(mark) == 1 and not closer and not spaced and nxt in ("l", "d", "o"):
            continue
        word = _WORD_AFTER.match(text, gap)
        nw = word[1].lower() if word else ""
        full = nxt
        if nxt in ("open", "dash"):
            full = nxt + (_kind(word[1][0]) if word else "-")
        tok = _TOKEN_BEFORE.search(text, max(0, s - 24), s)[0]
        lead = _TOKEN_BEFORE.search(text, max(0, s - 30), max(0, s - len(tok) - 1))[0] if tok and s - len(tok) > 0 else ""
        bare = tok.strip("«»“”\"'()[]¿¡—")
        if re.fullmatch(r"[^\W\d_]", bare):
            shape = "1U" if bare.isupper() else "1l"
        elif bare.isdigit():
            shape = "dd" if len(bare) <= 2 else "d"
        elif "." in bare[:-1]:
            shape = "dots"
        elif bare and len(bare) <= 4:
            shape = "short" + ("U" if bare[0].isupper() else "l")
        else:
            shape = "w"
        m0 = mark[0] if len(set(mark)) == 1 and len(mark) == 1 else "…" if set(mark) <= set(".…．") else "!"
        low = bare.lower()
        sp = "nl" if breaks else "sp" if spaced else "no"
        c0 = "(" if closer[:1] in ")）]" and closer else "q" if closer else ""
        f = [f"m:{m0}:{c0}:{full}", f"m:{m0}:{c0}:{sp}:{full}", f"m:{m0}:{shape}:{full}", f"m:{m0}:{shape}:{sp}"]
        if m0 == "." and not closer:
            f += [f"a:{low}:{full}", f"a:{low}", f"a2:{lead.lower()} {low}:{full}"]
            if shape in ("dd", "d"):
                f += [f"o:{lead.lower()}:{shape}", f"o:{shape}:{nw}"]
        if m0 == "…":
            f.append(f"e:{full}:{sp}")
            if full in ("ideo", "abj"):
                f.append(f"e:{'ideo' if full == 'ideo' else nw}")
        if closer:
            said = bool(_SPEECH.match(text[gap : gap + 14]))
            told = bool(_TOLD.search(text, max(0, s - 30), s))
            f += [f"q:{m0}:{said}:{full}", f"q:{told}:{said}", f"q:{c0}:{said}", f"q:{c0}:{told}:{full}"]
        out.append((e, f, False))
    return out


# ---------------------------------------------------------------------------------------------
# the linear-chain model


class Tagger:
    """Two tags, last (1) and inside (0), in a chain over the candidates; characters between them are inside."""

    def __init__(self):
        self.w: dict[str, float] = {}
        self.trans = [[0.0, 0.0], [0.0, 0.0]]

    def decode(self, cands) -> list[int]:
        """Viterbi over the candidates."""
        back: list[tuple[int, int]] = []
        s0, s1 = 0.0, 0.0
        t = self.trans
        for _, f, forced in cands:
            e = 1e6 if forced else sum(map(self.w.get, f, [0.0] * len(f)))
            a, b = (0, 1)
            x0, x1 = s0 + t[0][0], s1 + t[1][0]
            p0 = a if x0 >= x1 else b
            y0, y1 = s0 + t[0][1], s1 + t[1][1]
            p1 = a if y0 >= y1 else b
            back.append((p0, p1))
            s0, s1 = max(x0, x1), max(y0, y1) + e
        tags = [0] * len(cands)
        k = int(s1 > s0)
        for i in range(len(cands) - 1, -1, -1):
            tags[i] = k
            k = back[i][k]
        return tags

    def units(self, text: str) -> list[tuple[int, int]]:
        """[start, end) of each unit, without surrounding white space; they cover all else."""
        out = []
        at = 0
        c = candidates(text)
        for (e, _, _), tag in zip(c, self.decode(c)):
            if tag and e > at:
                self._add(text, at, e, out)
                at = e
        self._add(text, at, len(text), out)
        return out

    @staticmethod
    def _add(text: str, a: int, b: int, out: list) -> None:
        piece = text[a:b]
        s = piece.strip()
        if s:
            a += len(piece) - len(piece.lstrip())
            out.append((a, a + len(s)))

    def fit(self, docs: list[tuple[str, set[int]]], turns: int = 8) -> Tagger:
        """Averaged structured perceptron on texts with known unit ends."""
        data = [(c, [int(e in gold or forced) for e, _, forced in c]) for c, gold in ((candidates(t), g) for t, g in docs)]
        total: dict[str, float] = {}
        stamp: dict[str, int] = {}
        w, t, tt = self.w, self.trans, [[0.0, 0.0], [0.0, 0.0]]
        step = 0

        def add(k: str, v: float) -> None:
            total[k] = total.get(k, 0.0) + (step - stamp.get(k, 0)) * w.get(k, 0.0)
            stamp[k] = step
            w[k] = w.get(k, 0.0) + v

        rng = random.Random(3)
        for _ in range(turns):
            rng.shuffle(data)
            for c, gold in data:
                step += 1
                got = self.decode(c)
                if got != gold:
                    before_g = before_p = 0
                    for (_, f, forced), g, p in zip(c, gold, got):
                        if g != p and not forced:
                            for k in f:
                                add(k, 1.0 if g else -1.0)
                        t[before_g][g] += 0.1
                        t[before_p][p] -= 0.1
                        before_g, before_p = g, p
                for a in (0, 1):
                    for b in (0, 1):
                        tt[a][b] += t[a][b]
        for k in list(w):
            add(k, 0.0)
        self.w = {k: v / max(1, step) for k, v in total.items() if v}
        self.trans = [[x / max(1, step) for x in r] for r in tt]
        return self


_PLACE = {
    "es": ("en", "a orillas de", "cerca de"), "en": ("in", "near", "along the border with"), "pt": ("em", "perto de", "às margens de"),
    "fr": ("à", "près de", "sur les rives de"), "de": ("nahe", "am Ufer von", "bei"),
}


def _name(rng: random.Random) -> str:
    """An invented place name of one or two words."""
    w = "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiouáéó") for _ in range(rng.randint(2, 4))).capitalize()
    return w if rng.random() < 0.3 else f"{rng.choice(('Monte', 'Villa', 'Puerto', 'Santa', 'Rio', 'Valle', 'Alto'))} {w}"


def _strip_mark(s: str) -> str:
    return s.rstrip(".。।")


def _wrap(s: str, width: int, rng: random.Random) -> str:
    out, line = [], 0
    for w in s.split(" "):
        if line and line + len(w) > width:
            out.append("\n")
            line = 0
        elif out:
            out.append(" ")
        out.append(w)
        line += len(w) + 1
    return "".join(out)


def training(count: int = 8000, seed: int = 11) -> list[tuple[str, set[int]]]:
    """Texts put together from known units: other spacing, wrapped lines, headings, missing marks, missing spaces."""
    rng = random.Random(seed)
    pools = {k: [x for line in v.split("\n") for x in line.split("|")] for k, v in _SENTENCES.items()}
    heads = {k: v.split("|") for k, v in _HEADINGS.items()}
    weights = {"es": 4, "en": 3.5, "th": 4, "de": 3, "zh": 3, "ja": 2}
    out = []
    for _ in range(count):
        lang = rng.choices(list(pools), [weights.get(k, 1.5) for k in pools])[0]
        tight = lang in ("zh", "ja")
        text, ends = "", set()
        k = rng.randint(3, 9)
        width = rng.randint(48, 76)
        for j in range(k):
            if rng.random() < 0.45 and (not text or text.endswith("\n")):
                text += rng.choice(heads[lang])
                ends.add(len(text))
                text += rng.choice(["\n", "\n\n", "\n\n", "\r\n"])
            s = rng.choice(pools[lang])
            if lang in ("es", "en", "pt", "fr", "de") and rng.random() < 0.35 and s[-1] == ".":
                s = f"{s[:-1]} {_PLACE[lang][rng.randrange(3)]} Lima."
            if rng.random() < 0.35:
                s = re.sub(r"\b(?:Lima|Quito|Kiel|Chile)\b", lambda _: _name(rng), s)
            if rng.random() < 0.15:  # another year or number
                s = re.sub(r"\d+", lambda m: str(rng.randint(1, 10 ** len(m[0]))), s)
            if lang == "hi" and rng.random() < 0.2:
                s = s.replace("।", ".")
            if lang in ("zh", "ja") and rng.random() < 0.15:
                s = s.replace("。", "．")
            if lang in ("es", "en", "fr", "pt") and rng.random() < 0.2:
                s = s.replace("…", "...")
            if rng.random() < 0.2:
                s = s.replace("«", "“").replace("»", "”") if rng.random() < 0.5 else s.replace("“", '"').replace("”", '"').replace("„", '"')
            joiner = rng.choices([" ", "  ", "\n", "\n\n", ""], [56, 6, 11, 17, 10])[0]
            last = j == k - 1
            if (joiner == "\n\n" or last) and rng.random() < 0.15:
                s = _strip_mark(s)
            if not tight and lang != "th" and rng.random() < (0.5 if lang == "de" else 0.35):
                s = _wrap(s, width, rng)
            if joiner == "" and (lang == "th" or re.search(r"(?:etc|p\. m|p\.m|usw|\bд)\.$|\.\.\.$|…$", s) or not re.search(r"\w[.。।!?！？]$", s)):
                joiner = " "
            if tight and joiner == " ":
                joiner = ""
            text += s
            ends.add(len(text))
            text += joiner if not last else rng.choice(["", "\n"])
        out.append((text, ends))
    return out


@lru_cache(1)
def fitted() -> Tagger:
    return Tagger().fit(training())


RESULT = "doc_id bigint, inicio int, fin int"


def sentence_units(documents: DataFrame) -> DataFrame:
    """p9_found: (doc_id, inicio, fin), one row for each sentence unit of every document.

    Offsets are 0-based code points, without surrounding white space; units cover all else in the text.
    Null, empty and blank texts give no row; repeated rows give their units once.
    """
    model = fitted()
    shared = documents.sparkSession.sparkContext.broadcast((model.w, model.trans))

    def run(d: dict[str, list]) -> dict[str, list]:
        tagger = Tagger()
        tagger.w, tagger.trans = shared.value
        out: dict[str, list] = {"doc_id": [], "inicio": [], "fin": []}
        for i, t in zip(d["doc_id"], d["text"]):
            for a, b in tagger.units(t) if t else ():
                out["doc_id"].append(i)
                out["inicio"].append(a)
                out["fin"].append(b)
        return out

    rows = documents.select("doc_id", "text")
    return map_columns(rows, ["doc_id", "text"], RESULT, run).distinct()
