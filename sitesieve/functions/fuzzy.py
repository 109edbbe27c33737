"""Likeness of names, by Ratcliff and Obershelp's ratio, which Spark lacks: Arrow functions over small strings."""

from __future__ import annotations

import difflib
import functools
import itertools
import os
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import BooleanType, DoubleType, StringType

from sitesieve.functions import fixed
from sitesieve.functions import text as T

_WORD = re.compile(r"[^\W_]+")


def spelled_latin(x: str) -> str:
    return "".join(T.CYRILLIC.get(c, c) for c in x.lower())


@functools.lru_cache(1 << 16)
def sound(x: str) -> str:
    """text.squashed of a Python string."""
    key = re.sub("[^a-z0-9]", "", spelled_latin(x))
    for long, short in fixed.SQUASH:
        key = key.replace(long, short)
    return "".join(c for c, _ in itertools.groupby(re.sub("c(?!h)", "k", key)))


def alike(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


def are_alike(a: str, b: str, least: float) -> bool:
    """alike(a, b) >= least, with the bounds by length and by letters looked at first."""
    if 2 * min(len(a), len(b)) < least * (len(a) + len(b)):
        return False
    m = difflib.SequenceMatcher(None, a, b)
    return m.quick_ratio() >= least and m.ratio() >= least


def _mapped(f, kind):
    return lambda *columns: pa.array([f(*row) for row in zip(*(c.to_pylist() for c in columns), strict=True)], kind)


@F.arrow_udf(DoubleType())
def ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """The ratio of two strings; null if one is."""
    return _mapped(lambda x, y: None if x is None or y is None else alike(x, y), pa.float64())(a, b)


@F.arrow_udf(StringType())
def folded(x: pa.Array) -> pa.Array:
    """The form in which quotes are compared: NFKC, small letters, no quotation marks, one dash, no spaces beside
    ideographs."""
    return _mapped(lambda v: None if v is None else comparable(v), pa.string())(x)


def comparable(v: str) -> str:
    v = unicodedata.normalize("NFKC", v).lower().replace("ё", "е")
    v = re.sub(r"\s*([　-〿㐀-䶿一-鿿])\s*", r"\1", v)
    v = re.sub(r"[«»\"“”„'’`]", "", v)
    return " ".join(re.sub("[‐-―−]", "-", v).split()).strip(" .…")


def has_token(token: str, text: str, glued: bool) -> bool:
    """Whether a word of a company's name stands in a text: up to three letters as a whole word; longer ones at the
    start of a word, or by sound (alike by 0.85 from six letters on); glued: inside a longer word too."""
    token, text = token.lower(), text.lower()
    if not text:
        return False
    words, key = dict.fromkeys(_WORD.findall(text)), sound(token)
    if len(token) <= 3:
        return token in words or any(sound(w) == key for w in words)
    if any(w.startswith(token) for w in words) or re.search(rf"(?<![^\W_]){re.escape(token)}", text):
        return True
    if len(key) < 4:
        return False
    for other in map(sound, words):
        if key == other or (len(key) >= 5 and (other.startswith(key) or (glued and key in other))) or (len(key) >= 6 and are_alike(key, other, 0.85)):
            return True
    return glued and len(key) >= 5 and key in sound(text)


@F.arrow_udf(BooleanType())
def any_token(tokens: pa.Array, text: pa.Array, glued: pa.Array) -> pa.Array:
    """Whether one of the tokens stands in the text."""
    return _mapped(lambda t, x, g: any(has_token(w, x or "", g) for w in t or []), pa.bool_())(tokens, text, glued)


STRONG, GLUED, BODY = range(3)
_VALUES = pa.list_(pa.struct([("zone", pa.int32()), ("value", pa.string())]))
_RUN = re.compile(r"[^\s\x00-/:-`{-\x7f]+")


@F.arrow_udf(from_arrow_type(_VALUES))
def zone_values(strong: pa.Array, body: pa.Array) -> pa.Array:
    """The distinct runs of letters (signs that are not ASCII stay in them, so that no word is cut) of a page's strong text
    and of its body, and the strong text's sound key."""

    def one(s: str, b: str) -> list[tuple]:
        runs = dict.fromkeys(_RUN.findall(s.lower()))
        return [*((STRONG, x) for x in runs), (GLUED, sound.__wrapped__(s.lower())), *((BODY, x) for x in dict.fromkeys(_RUN.findall(b.lower())) if x not in runs)]

    return pa.array([[{"zone": z, "value": v} for z, v in one(s or "", b or "")] for s, b in zip(strong.to_pylist(), body.to_pylist(), strict=True)], _VALUES)


@F.arrow_udf(BooleanType())
def stands_in(word: pa.Array, value: pa.Array, zone: pa.Array) -> pa.Array:
    """has_token() of a word in one of zone_values()."""

    def one(w: str, v: str, z: int) -> bool:
        return len(w) > 3 and len(sound(w)) >= 5 and sound(w) in v if z == GLUED else has_token(w, v, z == STRONG)

    return _mapped(one, pa.bool_())(word, value, zone)


def name_fits_domain(company: Column, core: Column) -> Column:
    """Whether a company's name fits the brand's part of a domain."""
    zone = F.concat(F.replace(core, F.lit("-"), F.lit(" ")), F.lit(" "), F.replace(core, F.lit("-"), F.lit("")))
    return F.coalesce((core != "") & any_token(T.name_words(company), zone, F.lit(True)), F.lit(False))


def local_fits(local: str, surname: str, first: str, patronymic: str, kind: str, aliases: dict[str, list[str]]) -> str:
    """How a mailbox agrees with a person: surname, first, initials or nothing. It only confirms an address that is
    printed; none is made from a name."""
    tokens = [t for t in re.split("[^a-z]+", local.lower()) if t]
    letters = "".join(tokens)
    if not letters:
        return ""
    starts = {}
    for part, value in (("s", surname), ("f", first), ("p", patronymic)):
        c = value.strip().lower()[:1]
        if c:
            starts[part] = fixed.INITIAL_LETTERS.get(c, c if c.isascii() else "")
    own = sound(surname)
    if len(own) >= 3:
        for key in map(sound, dict.fromkeys([*tokens, letters])):
            if len(key) >= 3 and (own.startswith(key) or (len(own) >= 5 and own[:-1] in key) or (len(key) >= 4 and alike(key, own) >= 0.8)):
                return "surname"
    given = first.strip().lower().replace("ё", "е")
    if kind != "initials" and len(given) >= 3:
        known = {sound(x) for x in [given, *aliases.get(given, [])]}
        for key in (k for k in map(sound, tokens) if len(k) >= 3):
            for name in known:
                common = len(os.path.commonprefix([key, name]))
                rest = key[common:]
                if key == name or (len(key) >= 5 and alike(key, name) >= 0.84) or (common >= 3 and len(rest) <= 2 and set(rest) <= set("".join(starts.values()))):
                    return "first"
    return "initials" if _by_initials(letters, len(tokens), starts, surname, own) else ""


def _by_initials(letters: str, n_tokens: int, starts: dict[str, str], surname: str, own: str) -> bool:
    parts = [p for p in "fsp" if starts.get(p)]
    if 2 <= len(letters) <= 3 and "f" in starts and len(starts) >= 2:
        for order in itertools.permutations(parts, len(letters)):
            if all(c in starts[p] for c, p in zip(letters, order, strict=True)):
                return True
        if len(letters) == 3 and "p" not in starts and "s" in starts:  # one letter is free: the patronymic isn't printed
            return any(letters[i] in starts["f"] and letters[j] in starts["s"] for i, j in itertools.permutations(range(3), 2))
    if 4 <= len(letters) <= 6 and n_tokens == 1 and {"f", "p"} <= set(starts) and len(own) >= 4:
        spelled = re.sub("[^a-z]", "", spelled_latin(surname))
        for head, two in ((letters[:-2], letters[-2:]), (letters[2:], letters[:2])):
            if spelled.startswith(head) and two[0] in starts["f"] and two[1] in starts["p"]:
                return True
    return False
