"""What op10 sees in a text: mined words and beginnings, word lists, and patterns."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

from jobloom.llm.common import utf8

# Insults and contempt, by language and kind.
LEXICONS = {
    "en person": "idiot moron loser clown imbecile fool jerk cretin dimwit scumbag numbskull halfwit",
    "en contempt": "worthless pathetic stupid dumb retarded useless brainless shut hate despise",
    "en disgust": "trash scum disgusting vermin filth garbage vile sick",
    "en vulgar": "bastard bitch asshole whore slut shit crap fuck fucking damn",
    "en threat": "kill die hang rot burn",
    "de person": "idiot trottel depp dummkopf versager penner vollidiot schwachkopf arschloch",
    "de contempt": "dumm dämlich wertlos erbärmlich widerlich abschaum dreck scheiße hurensohn",
    "fr person": "idiot imbécile crétin abruti connard salaud débile bouffon",
    "fr contempt": "stupide pathétique minable dégoûtant ordure merde pute répugnant",
    "es person": "idiota imbécil estúpido tonto payaso pendejo cabrón gilipollas",
    "es contempt": "basura asqueroso patético inútil escoria mierda puta despreciable",
}
# Words of the lists that plain texts use too: they vote only beside another listed word.
PLAIN_TOO = (
    "shut hate kill die hang rot burn sick useless fool damn garbage vile despise dumb "
    "dumm dreck ordure stupide tonto inútil basura"
)
# Phrases, by a word that every text with the phrase has.
PHRASES = {
    "shut": ("shut up", "shut your mouth"), "kill": ("kill yourself",), "hell": ("go to hell",),
    "hate": ("i hate you", "we hate you"), "drop": ("drop dead",), "gueule": ("ta gueule", "ferme ta gueule"),
    "klappe": ("halt die klappe",), "fresse": ("halt die fresse",), "hasse": ("ich hasse dich",),
    "déteste": ("je te déteste",), "mierda": ("vete a la mierda",), "odio": ("te odio",),
    "callate": ("callate la boca",), "cállate": ("cállate la boca",),
}
# What stands before an insult of the person that is spoken to.
ADDRESS = {"you", "youre", "your", "du", "ihr", "tu", "toi", "vous", "eres", "sois"}
PATTERNS = ("masked", "spaced", "stretched", "address", "phrase", "repeated", "shouted", "several lists")
# Signs that stand for letters in masked words.
SIGNS = str.maketrans("013457@$!|", "oieastasil")

BEGINNINGS = (4, 5, 6, 7)
SEVERAL = (2, 3)  # different words of one beginning
FAMILY = 4  # features of one kind that begin alike in so many letters are one voter

# All ASCII but letters ends a word, and of the rest U+0080-00BF and general punctuation.
_TO_SPACES = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))
_BEYOND = re.compile("[\u0080-\u00bf\u2000-\u206f\u3000-\u3003]")
_IS_SIGN = np.isin(np.arange(256), np.frombuffer(b"*@$!|#0123456789", np.uint8))
_MASKED = re.compile(r"[^\W_]+(?:[*@$!|#0-9.]+[^\W_]+)+")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-*]){3,}[^\W\d_](?!\w)")
_STRETCH = re.compile(r"(.)\1{2,}")
_SIGN = re.compile(r"[*@$!|#0-9]")
_PHRASE_KEYS = frozenset(PHRASES)
_LISTS = [frozenset(words.split()) for words in LEXICONS.values()]
_LISTED = {w: tuple(i for i, words in enumerate(_LISTS) if w in words) for w in frozenset().union(*_LISTS)}
STRONG = frozenset(_LISTED) - frozenset(PLAIN_TOO.split())
_LONGEST = max(map(len, STRONG))
_LETTERS = frozenset("".join(STRONG))
WORDS_KEPT = 200_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    lowered = (text or "").lower()
    data = utf8(lowered)
    if b"\xc2" in data or b"\xe2\x80" in data or b"\xe2\x81" in data or b"\xe3\x80" in data:
        data = utf8(_BEYOND.sub(" ", lowered))
    return data.translate(_TO_SPACES).decode("utf-8", "surrogatepass").split()


def features_of(words: set[str]) -> set[str]:
    """The words, their beginnings marked by a tilde, and those of several different words."""
    found = {w for w in words if len(w) > 2}
    for n in BEGINNINGS:
        begun = Counter(w[:n] for w in words if len(w) > n)
        found.update(b + "~" for b in begun)
        found.update(f"{b}~{k}" for b, times in begun.items() if times > 1 for k in SEVERAL if times >= k)
    return found


def family_of(feature: str) -> tuple[str, int]:
    """The first letters, and how many different words the feature asks for."""
    return feature[:FAMILY], int(feature.partition("~")[2] or 1)


def _holds(wide: str, narrow: str) -> bool:
    """Whether every text with the second feature has the first one, of the same family."""
    begun, mark, _ = wide.partition("~")
    return bool(mark) and family_of(wide) == family_of(narrow) and narrow.startswith(begun)


def wider(feature: str) -> list[str]:
    """Features that every text with this one has too: its beginnings, and as many words of
    a shorter beginning."""
    stem, _, several = feature.partition("~")
    marks = ["~", "~" + several] if several else ["~"]
    found = [stem[:n] + mark for n in BEGINNINGS if n <= len(stem) for mark in marks]
    return [f for f in found if f != feature]


def beyond_chance(a: int, b: int, share: float) -> float:
    """Chernoff's bound for a of a + b where ``share`` of all is expected, as -log(chance)."""
    own = a / (a + b)
    if own <= share:
        return 0.0
    rest = b * math.log((1 - own) / (1 - share)) if b else 0.0
    return a * math.log(own / share) + rest


def distinct_features(
    counts: dict[str, tuple[int, int]], around: dict[str, tuple[int, int, int]], by_chance: float
) -> list[str]:
    """Features, by their toxic and clean texts, that say more than their beginnings do.

    The best of many words of one beginning seem better than the others by chance alone. So a
    feature stays only if it is typical beyond what each of its beginnings is, in view of the
    number of candidates that begin so; ``around`` has toxic and clean texts, and candidates.
    """
    def stays(feature: str) -> bool:
        a, b = counts[feature]
        for f in wider(feature):
            if f in around:
                x, y, candidates = around[f]
                if beyond_chance(a, b, x / (x + y)) < math.log(max(candidates, 1) / by_chance):
                    return False
        return True

    return sorted(filter(stays, counts))


def without_blurred(counts: dict[str, tuple[int, int]]) -> list[str]:
    """Features, by their toxic and clean texts, without those beginnings that a narrower
    feature stands for: one with nearly all toxic texts and fewer clean ones, or most of the
    toxic and less than half the clean ones."""
    families: dict[str, list[str]] = {}
    for f in counts:
        families.setdefault(f[:FAMILY], []).append(f)

    def blurred(f: str) -> bool:
        a, b = counts[f]
        return any(
            (x >= 0.95 * a and y < b or x >= 0.8 * a and 2 * y < b) and g != f and _holds(f, g)
            for g in families[f[:FAMILY]]
            for x, y in (counts[g],)
        )

    return sorted(f for f in counts if not blurred(f))


def _is_masked(text: str) -> bool:
    """An insult with signs for letters, or with one to three letters starred out."""
    data = np.frombuffer(utf8(text), np.uint8)
    sign = _IS_SIGN[data]
    # A sign behind a letter, with a letter or another sign behind it.
    if not (sign[1:-1] & (data[:-2] > 64) & (sign[2:] | (data[2:] > 64))).any():
        return False
    for token in text.lower().split():
        if not _SIGN.search(token):
            continue
        for part in _MASKED.findall(token):
            if part.translate(SIGNS) in STRONG and part not in STRONG:
                return True
            if ("*" in part or "#" in part) and sum(c in "*#" for c in part) <= 3 < len(part) <= _LONGEST:
                shape = re.compile("".join("." if c in "*#" else re.escape(c) for c in part))
                if any(map(shape.fullmatch, STRONG)):
                    return True
    return False


def _is_spaced(text: str, distinct: set[str]) -> bool:
    if len(_LETTERS & distinct) < 3:
        return False
    return any(re.sub(r"[ .\-*]", "", found).lower() in STRONG for found in _SPACED.findall(text))


def _is_stretched(lowered: str, distinct: set[str]) -> bool:
    data = np.frombuffer(utf8(lowered), np.uint8)
    if not ((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] > 64)).any():
        return False
    return any(
        _STRETCH.sub(r"\1", w) in STRONG or _STRETCH.sub(r"\1\1", w) in STRONG
        for w in distinct if _STRETCH.search(w)
    )


def patterns_of(text: str | None, words: list[str], distinct: set[str]) -> int:
    """A bit for each of PATTERNS."""
    text = text or ""
    strong = STRONG & distinct
    phrases = [p for key in _PHRASE_KEYS & distinct for p in PHRASES[key]]
    joined = f" {' '.join(words)} " if phrases else ""
    lists = {i for w in strong for i in _LISTED[w]}
    at = [i for i, w in enumerate(words) if w in strong] if strong else []
    seen = (
        _is_masked(text),
        _is_spaced(text, distinct),
        _is_stretched(text.lower(), distinct),
        any(not ADDRESS.isdisjoint(words[max(0, i - 4) : i]) for i in at),
        any(f" {p} " in joined for p in phrases),
        len(at) > 1,
        any(w.upper() in text for w in strong if w.upper() != w),
        len(lists) > 1,
    )
    return sum(1 << i for i, hit in enumerate(seen) if hit)


@dataclass
class Cues:
    """Cues of a text, as numbers: mined features, then the word lists, then the patterns.

    The classifier's columns are the voters' toxic votes, so that a mined word weighs as its
    family does.
    """

    place: dict[str, int]
    met: dict[str, tuple] = field(default_factory=dict)

    def __post_init__(self):
        number = {f: i for i, f in enumerate(sorted(set(map(family_of, self.place))))}
        self.family = np.array([number[family_of(f)] for f in self.place], np.int64)
        self.families = len(number)
        # No other word has a cue.
        self.stems = {f[:FAMILY] for f in (*self.place, *_LISTED)}
        # Fewer words say less where more of the kind are; then only those vote.
        both = [
            (number[stem, few], i) for (stem, many), i in number.items()
            for few in range(many - 1, 0, -1) if (stem, few) in number
        ]
        self.single, self.several = (np.array([b[k] for b in both], np.int64) for k in (0, 1))

    @property
    def width(self) -> int:
        return self.families + len(LEXICONS) + len(PATTERNS)

    @property
    def voters(self) -> int:
        """A voter for each family of mined features, each list and each pattern, and two that
        vote clean: where there is no cue at all, and where there is one only, a single word."""
        return self.width + 2

    def _meet(self, word: str) -> tuple:
        """(columns of the word and its beginnings, beginnings of which several count, lists)"""
        begun = [word[:n] for n in BEGINNINGS if len(word) > n]
        columns = [self.place[f] for f in (word, *(b + "~" for b in begun)) if f in self.place]
        several = [b for b in begun if any(f"{b}~{k}" in self.place for k in SEVERAL)]
        found = tuple(columns), tuple(several), _LISTED.get(word, ())
        if len(self.met) > WORDS_KEPT:
            self.met.clear()
        self.met[word] = found = found if any(found) else ()
        return found

    def of(self, text: str | None) -> list[int]:
        words = words_of(text)
        distinct = set(words)
        return self.of_words(distinct, patterns_of(text, words, distinct))

    def of_words(self, words: set[str], patterns: int) -> list[int]:
        found: set[int] = set()
        begun: dict[str, int] = {}
        listed: dict[int, int] = {}
        met = self.met
        stems = self.stems
        for word in words:
            if word[:FAMILY] not in stems:
                continue
            cue = met.get(word)
            if cue is None:
                cue = self._meet(word)
            if cue:
                found.update(cue[0])
                for b in cue[1]:
                    begun[b] = begun.get(b, 0) + 1
                for i in cue[2]:
                    listed[i] = listed.get(i, 0) + 1
        found.update(
            self.place[f] for b, n in begun.items() for k in SEVERAL if n >= k and (f := f"{b}~{k}") in self.place
        )
        if listed:
            strong = not STRONG.isdisjoint(words)
            found.update(len(self.place) + i for i, n in listed.items() if strong or n > 1)
        first = len(self.place) + len(LEXICONS)
        found.update(first + i for i in range(len(PATTERNS)) if patterns >> i & 1)
        return sorted(found)

    def votes(self, rows: list[list[int]]) -> np.ndarray:
        """texts x voters: +1 toxic, -1 clean, 0 no vote."""
        votes = np.zeros((len(rows), self.voters), np.int8)
        mined = len(self.place)
        for vote, row in zip(votes, rows, strict=True):
            for f in row:
                vote[self.family[f] if f < mined else self.families + f - mined] = 1
        for few, many in zip(self.single, self.several):
            votes[:, few] *= votes[:, many] == 0
        toxic = votes.sum(axis=1)
        votes[:, -2] = np.where(toxic == 0, -1, 0)
        votes[:, -1] = np.where((toxic == 1) & (votes[:, self.several].sum(axis=1) == 0), -1, 0)
        return votes

    def columns(self, rows: list[list[int]]) -> list[list[int]]:
        """Columns of the classifier."""
        votes = self.votes(rows)[:, : self.width] > 0
        return [np.flatnonzero(v).tolist() for v in votes]

    def built_in(self) -> np.ndarray:
        """voters x voters: whether they go together by construction. A clean voter speaks
        where others are silent, the patterns read the words of the lists, and a family's
        single words are silent where several are."""
        kind = np.repeat([0, 1, 2], [self.families, len(LEXICONS) + len(PATTERNS), 2])
        one, other = kind[:, None], kind
        found = (one == 2) | (other == 2) | (one == 1) & (other == 1) | np.eye(self.voters, dtype=bool)
        found[self.single, self.several] = found[self.several, self.single] = True
        return found
