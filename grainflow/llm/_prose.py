"""Which parts of a text are connected sentences: units of a text, their words and characters."""

from __future__ import annotations

import re
from collections import Counter

# fixed values: function words by language
FUNCTION_WORDS = {
    "en": """a after again all although among an and any are as at be because been before between both but by can
    could did do does during each either every everyone for from had has have he her his how i if in into is it its
    many may me merely most my near neither never no nobody nor not of on once only or our over per she should
    since so some such than that the their them then there these they this those though through to under until us
    was we were what when where whereas which while who whom whose why will with within without would yet you your""",
    "fr": """au aux avec c ce ces cette chaque comme d dans de depuis des du elle en encore est et eux il ils j je l la le les
    leur leurs mais même n ne nous on ont ou où par pas plus pour qu que qui sa sans se selon ses si son sont sous sur
    tout toute toutes tous très un une vous était être""",
    "de": """aber alle als am an auch auf aus bei bis da das dass dem den der des die diese dieser dieses durch ein eine
    einem einen einer eines er es für hat ich ihr im ist jede jeder jedes kann mit nach nicht noch nur oder seien
    sein seit seiner sich sie sind sondern um und uns unter vom von vor was wenn wer wie wir wird wo zu zum zur
    über""",
    "es": """al aunque cada como con cuando de del desde donde el ella en entre era es esa ese esta este esto fue ha
    había hace hasta la las le lo los más me mi muy ni no para pero por porque que quien se según ser si sin sobre
    son su sus también un una unas unos y ya""",
}
WORDS_OF = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
COMMON = frozenset().union(*WORDS_OF.values())
LANGS = tuple(WORDS_OF)
#: function words that one language alone has tell it
OWN = {w: k for k in LANGS for w in WORDS_OF[k] if sum(w in WORDS_OF[x] for x in LANGS) == 1}

TAG = re.compile(r"<[^<>\n]{0,400}>")
ENTITY = re.compile(r"&#?\w{1,10};")
SYMBOL = re.compile(r"[^\w\s]|_")
ITEM = re.compile(r"\s*(?:>\s*)*(?:[-*•·o‣–]|\(?\d{1,3}[.)]|<li\b[^>]*>)\s")
STRIP = "\"'“”„«»‘’.,;:!?()[]{}¿¡…-–—*_#>|​﻿"
SENTENCE_END = re.compile(r"[.!?…]+[\"'”’»)\]]*(?:\s+|$)")
UNIT, LEAST_COMMON, NEAR = 40, 0.06, 12
#: where a text holds hardly any known function words: length of a word that may be one of another language, the
#: least share of such words in the text, their mean length at most, and the least number of different ones;
#: scripts other than Latin, whose small words are often written together with others, need a fourth of it
SHORT, LEAST_GLUE, MEAN_GLUE, KINDS = 4, 0.2, 3.5, 4
LATIN = re.compile(r"[a-z\u00df-\u024f\u1e00-\u1eff]")
#: letters of scripts that write no blanks between words, and their sentence marks
DENSE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
MARKS = re.compile(r"[\u3001\u3002\uff01\uff0c\uff1f\u104a\u104b\u17d4]")


def words_of(text: str) -> list[str]:
    """Lower-cased white-space tokens without the punctuation around them."""
    low = text.lower()
    if "'" in low or "’" in low:  # the article or pronoun before an apostrophe is a word
        low = low.replace("’", "'").replace("'", "' ")
    return [w for t in low.split() if (w := t.strip(STRIP))]


def common(words: list[str]) -> int:
    """How many of the words are function words of any language."""
    return sum(map(COMMON.__contains__, words))


def units(text: str) -> list[tuple[int, list[str], int, bool]]:
    """(characters other than white space, words, common words, is a bare list item) of each line,
    or of each UNIT words of a longer line; a blank line gives an empty unit."""
    out = []
    for line in text.splitlines():
        chars = len(line) - line.count(" ")
        if not chars or line.isspace():
            out.append((0, [], 0, False))
            continue
        plain = ENTITY.sub(" ", TAG.sub(" ", line)) if "<" in line or "&" in line else line
        w = words_of(plain)
        n = len(w)
        bare = n <= 9 and ITEM.match(line) is not None and plain.rstrip()[-1:] not in ".!?…\"”’»)"
        if n <= UNIT + UNIT // 2:
            out.append((chars, w, common(w), bare))
        else:
            parts = -(-n // UNIT)
            for k in range(parts):
                part = w[k * n // parts : (k + 1) * n // parts]
                out.append((chars * len(part) // n, part, common(part), False))
    return out


def glue_words(us: list[tuple[int, list[str], int, bool]]) -> frozenset[str]:
    """What holds the sentences of a text together in whatever language: short words without digits that come
    again and again. Function words are the shortest and most frequent words of every language; a text shows
    its own."""
    n: Counter = Counter()
    for u in us:
        n.update(w for w in u[1] if len(w) <= SHORT and w.isalpha())
    total = sum(len(u[1]) for u in us)
    return frozenset(w for w, c in n.items() if c >= max(2, total / 100))


def _foreign(text: str, us: list[tuple[int, list[str], int, bool]]) -> list[bool]:
    """Which units are sentences of a language without known function words: a dense script with its sentence
    marks, or lines that end as sentences do and are made of words, in a text that glue_words() hold together."""
    glue = glue_words(us)
    words = [w for u in us for w in u[1]]
    held = [w for w in words if w in glue]
    latin = len(LATIN.findall(" ".join(words))) > 0.5 * sum(map(len, words))
    joined = len(held) >= LEAST_GLUE * (1.0 if latin else 0.25) * len(words) and len(glue) >= (KINDS if latin else 1) and sum(map(len, held)) <= MEAN_GLUE * len(held)
    k, out = 0, []
    for line in text.splitlines():
        chars, first, whole = len(line) - line.count(" "), k, 0
        while k < len(us) and (k == first or whole < chars * 0.98) and (k == first or chars and not line.isspace()):
            whole += us[k][0]
            k += 1
        part = us[first:k]
        dense = len(DENSE.findall(line))
        if dense >= 8 and dense >= 0.6 * chars:
            good = bool(MARKS.search(line)) or dense >= 20
        else:
            w = [x for u in part for x in u[1]]
            letters = sum(not any(c.isdigit() for c in x) for x in w)
            ended = line.rstrip().rstrip("\"'”’»)]")[-1:] in (".", "!", "?", "…", "।", "۔", "؟")
            good = joined and len(w) >= 5 and ended and letters >= 0.85 * len(w)
        out += [good and not u[3] for u in part]
    return out + [False] * (len(us) - len(out))


def prose_units(text: str) -> tuple[list[tuple[int, list[str], int, bool]], list[bool]]:
    """The units of a text, and whether each is connected sentences, in any language.

    A unit is prose if known function words are at least LEAST_COMMON of its words; a short unit is taken
    with the units next to it in the same block of lines until there are NEAR words. A text that has
    hardly any of them is looked at again by _foreign().
    """
    us = units(text)
    ok = []
    for k, (chars, w, common, bare) in enumerate(us):
        if not chars or bare:
            ok.append(False)
            continue
        n, c, lo, hi = len(w), common, k - 1, k + 1
        while n < NEAR:
            grown = False
            if lo >= 0 and us[lo][0]:
                n, c, lo, grown = n + len(us[lo][1]), c + us[lo][2], lo - 1, True
            if hi < len(us) and us[hi][0]:
                n, c, hi, grown = n + len(us[hi][1]), c + us[hi][2], hi + 1, True
            if not grown:
                break
        ok.append(n > 0 and c >= LEAST_COMMON * n)
    if sum(u[2] for u in us) < 0.03 * sum(len(u[1]) for u in us):
        ok = [a or b for a, b in zip(ok, _foreign(text, us), strict=True)]
    return us, ok


def repeated_share(text: str) -> float:
    """Share of characters in sentences or lines that occur three times or more, or again."""
    if len(text) < 60:
        return 0.0
    parts = [s.strip() for s in SENTENCE_END.split(" ".join(text.lower().split()))]
    if len(parts) < 3:  # no sentence ends: runs of eight words
        w = words_of(text)
        parts = [" ".join(w[k : k + 8]) for k in range(len(w) - 7)]
    seen = Counter(p for p in parts if len(p) > 12)
    if all(n == 1 for n in seen.values()):
        return 0.0
    total = sum(map(len, parts)) or 1
    return sum(len(p) * (n if n > 2 else n - 1) for p, n in seen.items()) / total


def language(counts: Counter, words: int) -> str:
    """The language whose own function words are most, or und where they are few."""
    if not counts:
        return "und"
    k, n = max(counts.items(), key=lambda x: (x[1], x[0]))
    return k if n >= 0.03 * words else "und"
