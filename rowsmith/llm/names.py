"""Names typed by people: reading and comparing them."""

from __future__ import annotations

import html
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

# Short and other forms of given names, by the full form.
GIVEN = {
    "william": "bill will billy willie", "robert": "bob rob bobby bert", "richard": "dick rick rich ricky", "thomas": "tom tommy",
    "james": "jim jimmy jamie", "michael": "mike mick mickey", "matthew": "matt", "christopher": "chris kit topher",
    "patricia": "pat patty trish tricia", "nathaniel": "nate nat", "bartholomew": "bart", "anthony": "tony", "theodore": "ted teddy theo",
    "lawrence": "larry lars", "leonard": "leo len lenny", "andrew": "andy drew", "timothy": "tim", "josephine": "jo josie",
    "archibald": "archie", "edward": "ed eddie ned", "margaret": "maggie meg peggy marge", "ignacio": "nacho", "charles": "charlie chuck",
    "eleanor": "ellie nell nora", "dorothy": "dot dottie", "walter": "walt wally", "kenneth": "ken kenny", "raymond": "ray",
    "guadalupe": "lupe", "elizabeth": "liz beth betty eliza betsy", "pamela": "pam", "gregory": "greg", "samuel": "sam sammy samantha",
    "harold": "harry hal", "valentina": "val vale tina", "frederick": "fred freddy", "jonathan": "jon johnny", "benjamin": "ben benny",
    "gerald": "jerry gerry", "barbara": "barb babs", "francisco": "paco pancho frank", "stephanie": "steph stevie",
    "jacqueline": "jackie", "rebecca": "becky becca", "katherine": "kate kathy katie kat", "maria": "mari mary", "abigail": "abby gail",
    "susannah": "sue susie susan", "vincent": "vince vinny", "alexander": "alex al xander sasha", "deborah": "deb debbie debby", "winifred": "winnie",
    "chukwuemeka": "emeka", "penelope": "penny", "zachary": "zach zack", "victoria": "vicky tori vicki", "jose": "pepe joe",
    "mohammed": "mo moe muhammad mohamed", "oluwaseun": "seun olu",
}
# Forms of a company, left out of comparisons.
LEGAL = frozenset("llc inc incorporated corp corporation co company ltd limited pllc plc lp llp pc".split())
# Words of holding companies, whose names say nothing of the business they run.
HOLDING = frozenset("holdings enterprises ventures investments".split())
_FULL = {short: full for full, shorts in GIVEN.items() for short in shorts.split()}
_DBA = re.compile(r"\b(?:d\s*[/.]\s*b\s*[/.]\s*a\b\.?|dba\b|t\s*/\s*a\b|trading\s+as\b|doing\s+business\s+as\b|a\s*/\s*k\s*/\s*a\b|aka\b)\s*:?\s*", re.I)
_LIABILITY = re.compile(r"\blimited\s+liability\s+company\b", re.I)
_DOTTED = re.compile(r"\b((?:[a-z]\.){2,}[a-z]?)(?=\W|$)", re.I)
_POSSESSIVE = re.compile(r"(?<=\w)['’`´]+s\b")
_PLACE = re.compile(r"\s*(?:\(([^()]*)\)|\s[-–]\s*([a-z .']+)|,\s*([a-z .']+)|\s(?:of|in)\s+([a-z .']+))\s*$")
_WORDS = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    text = html.unescape(text)
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in text if not unicodedata.combining(ch)).lower()


@dataclass(frozen=True)
class Name:
    """A name as read: words in order, the town it appends, the legal name in front of a trade name."""

    words: tuple[str, ...]
    town: str
    legal: tuple[str, ...]
    holding: bool

    @property
    def core(self) -> str:
        """The words in alphabetical order; spellings that only rearrange share it."""
        return " ".join(sorted(self.words))


def _tokens(text: str) -> tuple[str, ...]:
    text = _POSSESSIVE.sub("", text)
    words = [w for w in _WORDS.findall(text) if w not in ("and", "by", "of", "at")]
    while len(words) > 1 and words[-1] in LEGAL:
        words.pop()
    if len(words) > 1 and words[0] == "the":
        words.pop(0)
    words = [w for i, w in enumerate(words) if not (w in LEGAL and w not in ("co", "company") and len(words) > 2)]
    return tuple(_FULL.get(w, w) for w in words)


@lru_cache(maxsize=5_000)
def read_name(raw: str | None) -> Name:
    """Reads a name as typed; the place it ends with is set apart, places among its first words are not."""
    from .addresses import find_town

    text = fold(raw or "").replace("\xa0", " ")
    text = _LIABILITY.sub("llc", text)
    text = _DOTTED.sub(lambda m: m.group(1).replace(".", ""), text)
    parts = _DBA.split(text, maxsplit=1)
    legal = _tokens(parts[0]) if len(parts) > 1 and parts[1].strip() else ()
    text = parts[1] if legal else parts[0]
    text = " ".join(text.split()).strip(" .*!?,;-")
    town = ""
    bare = re.sub(r"[\s,.]+(?:llc|inc|incorporated|corp|corporation|co|company|ltd|limited|pllc)[\s.,*]*$", "", text)
    for form in (text, bare):  # the place may stand before or behind the form of the company
        m = _PLACE.search(form)
        place = find_town(" ".join(_WORDS.findall(next((g for g in m.groups() if g), "")))) if m else ""
        if place and form[: m.start()].strip():
            town, text = place, form[: m.start()]
            break
    words = _tokens(text)
    return Name(words, town, legal, not legal and bool(words) and words[-1] in HOLDING)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by words of bits."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        if m := masks.get(ch):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths, 0 to 1."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 0.0


@lru_cache(maxsize=50_000)
def word_match(a: str, b: str) -> float:
    """How well two words agree: typos by LCS ratio, first letters and abbreviations by rule."""
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    if a[0] == b[0]:
        if len(a) == 1:
            return 0.7
        if len(a) >= 2 and b.startswith(a):
            return 0.9
        if 2 <= len(a) <= 6 and len(a) < len(b) and lcs(a, b) == len(a):
            return 0.8
    r = ratio(a, b)
    return r if r >= 0.75 else 0.0


def name_match(a: tuple[str, ...], b: tuple[str, ...], weight) -> tuple[float, float]:
    """(share of the shorter name's weight found in the other, LCS ratio of the words so aligned).

    ``weight``: of a word; common words weigh less than rare ones.
    """
    if not a or not b:
        return 0.0, 0.0
    if a == b:
        return 1.0, 1.0
    pairs = sorted(((word_match(x, y), i, j) for i, x in enumerate(a) for j, y in enumerate(b)), key=lambda p: (-p[0], p[1], p[2]))
    used_a: dict[int, float] = {}
    used_b: dict[int, float] = {}
    order: list[tuple[int, int]] = []
    for s, i, j in pairs:
        if s <= 0:
            break
        if i not in used_a and j not in used_b:
            used_a[i] = used_b[j] = s
            order.append((i, j))
    wa, wb = [weight(x) for x in a], [weight(y) for y in b]
    share = max(
        sum(wa[i] * s for i, s in used_a.items()) / sum(wa) if sum(wa) <= sum(wb) else 0.0,
        sum(wb[j] * s for j, s in used_b.items()) / sum(wb) if sum(wb) <= sum(wa) else 0.0,
    )
    rest_a = [x for i, x in enumerate(a) if i not in used_a]
    rest_b = [y for j, y in enumerate(b) if j not in used_b]
    left = "".join([*(a[i] for i, _ in order), *rest_a])
    right = "".join([*(b[j] for _, j in order), *rest_b])
    whole = ratio("".join(a), "".join(b))  # words run together or split still agree as a whole
    if "".join(a) == "".join(b):
        share = 1.0
    elif share < 0.8 and whole >= 0.85 and len(a) != len(b):
        share = max(share, whole)
    return share, max(ratio(left, right), whole)
