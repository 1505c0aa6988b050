"""Keyed surrogates for personal data.

Detected entities are replaced by others of the same type and format. A surrogate is a keyed bijection
of the entity within its format: the characters that may change are one number in a mixed radix, a
Feistel network P permutes these numbers, and the surrogate is P^-1(P(x) + 1). So different entities
of a type have different surrogates over any number of documents, equal ones have the same
(coreference), none keeps its value, and no table of pairs is needed. Known given names move within
their gender and script; other names change letters within their script, vowels to vowels, and
keep a gender-marking ending. A check of every text confirms that no two entities share a surrogate.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm import kernel

# Titles by the gender they tell, given names by gender and script.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"),
    "": ("Dr", "Prof"),
}
GIVEN = {
    ("f", "LATIN"): ("Alice", "Anna", "Carmen", "Claire", "Elena", "Emma", "Greta", "Helen", "Irene", "Julia", "Laura", "Lucía",
                     "Maria", "María", "Marie", "Nora", "Paula", "Sarah", "Sofia", "Sophie"),
    ("m", "LATIN"): ("Adam", "Antonio", "Carlos", "Daniel", "David", "Felix", "Hans", "Henri", "Jack", "James", "Jean", "John",
                     "José", "Karl", "Louis", "Luis", "Michael", "Paul", "Peter", "Thomas"),
    ("f", "CYRILLIC"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Татьяна"),
    ("m", "CYRILLIC"): ("Антон", "Борис", "Виктор", "Иван", "Михаил", "Олег", "Павел", "Сергей"),
}
ALPHABETS = {
    "LATIN": ("aeiouy", "bcdfghjklmnpqrstvwxz"),
    "GREEK": ("αεηιουω", "βγδζθκλμνξπρστφχψ"),
    "CYRILLIC": ("аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ"),
}
HEX, DIGITS = "0123456789abcdef", "0123456789"

_PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[\w.+-]{1,64}@[\w-]+(?:\.[\w-]+)+"),
    "ip": re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w.]*\d)"),
    "phone": re.compile(r"(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w)|(?<!\w)\+\d{8,14}(?!\w)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "card": re.compile(r"(?<!\w)(?:[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|3[47]\d{2}[ -]\d{6}[ -]\d{5})(?!\w)"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "key": re.compile(r"(?<!\w)(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)|(?<!\w)[0-9a-f]{32,64}(?!\w)"),
}
#: groups of any size behind a country code or a trunk zero, with the digits they may have
_GROUPED_PHONES = (
    (re.compile(r"(?<!\w)\+\d{1,3}(?:[ ./-]?\(?\d{1,8}\)?){1,7}(?!\w)"), 8, 15),
    (re.compile(r"(?<![\w+.,/-])(?:\(0\d{1,5}\) ?|0\d{1,5}[ ./-])\d{2,8}(?:[ ./-]\d{2,8}){0,4}(?!\w)"), 9, 13),
)
_DATE = re.compile(r"\d{2}[./-]\d{2}[./-]\d{4}")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_SECRET = re.compile(r"(?i)(?<!\w)(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?([^\s\"',;]{5,}[^\s\"',;:.!?)\]])")
_TITLE = re.compile(
    r"(?<!\w)(" + "|".join(t for titles in TITLES.values() for t in titles) + r")\.? ((?:[^\W\d_][\w'’-]+ ?){1,3})"
)
_GIVEN = re.compile(
    r"(?<!\w)(?=[" + "".join(sorted({n[0] for names in GIVEN.values() for n in names})) + r"])(?:"
    + "|".join(sorted((n for names in GIVEN.values() for n in names), key=len, reverse=True))
    + r")((?: [^\W\d_][\w'’-]+){1,2})"
)
_GENDER = {t: gender for gender, titles in TITLES.items() for t in titles}


def _key(secret: bytes, *parts: str) -> bytes:
    return hashlib.blake2b("\x1f".join(parts).encode(), key=secret, digest_size=32).digest()


def _round(key: bytes, turn: int, value: int, size: int) -> int:
    need = (size.bit_length() + 7) // 8 + 8
    out = b""
    while len(out) < need:
        out += hashlib.blake2b(value.to_bytes(64, "big") + bytes([turn, len(out) & 255]), key=key, digest_size=32).digest()
    return int.from_bytes(out[:need], "big") % size


def shifted(value: int, size: int, key: bytes) -> int:
    """A keyed bijection of [0, size) without fixed points, for sizes above 1: P^-1(P(value) + 1)."""
    if size < 2:
        return value
    low = 1 << (size.bit_length() // 2)
    high = -(-size // low)

    def once(x: int, turns: range, sign: int) -> int:
        a, b = divmod(x, low)
        for turn in turns:
            if turn % 2:
                a = (a + sign * _round(key, turn, b, high)) % high
            else:
                b = (b + sign * _round(key, turn, a, low)) % low
        return a * low + b

    def walk(x: int, turns: range, sign: int) -> int:
        x = once(x, turns, sign)
        while x >= size:  # stay within the numbers that exist
            x = once(x, turns, sign)
        return x

    moved = (walk(value, range(8), 1) + 1) % size
    return walk(moved, range(7, -1, -1), -1)


def recoded(text: str, alphabets: list[str | None], key: bytes) -> str:
    """``text`` moved within the alphabets of its positions; None keeps a character."""
    value, size = 0, 1
    for char, alphabet in zip(text, alphabets, strict=True):
        if alphabet is not None:
            value, size = value * len(alphabet) + alphabet.index(char), size * len(alphabet)
    value = shifted(value, size, key)
    out = list(text)
    for i in range(len(text) - 1, -1, -1):
        if (alphabet := alphabets[i]) is not None:
            value, digit = divmod(value, len(alphabet))
            out[i] = alphabet[digit]
    return "".join(out)


def _plain_class(char: str) -> str | None:
    if char in DIGITS:
        return DIGITS
    if "a" <= char <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    if "A" <= char <= "Z":
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return None


def _by_class(text: str, secret: bytes, kind: str, keep: int = 0) -> str:
    classes = [None] * keep + [_plain_class(c) for c in text[keep:]]
    form = "".join(c if a is None else a[0] for c, a in zip(text, classes, strict=True))
    return recoded(text, classes, _key(secret, kind, form))


def _email(text: str, secret: bytes) -> str:
    text = text.lower()
    tail = text.rpartition(".")[2]
    return _by_class(text[: len(text) - len(tail)], secret, f"email {tail}") + tail


def _ip(text: str, secret: bytes) -> str:
    if ":" in text:
        return str(ipaddress.IPv6Address(shifted(int(ipaddress.IPv6Address(text)), 1 << 128, _key(secret, "ip6"))))
    value = int(ipaddress.IPv4Address(".".join(str(int(p)) for p in text.split("."))))
    return str(ipaddress.IPv4Address(shifted(value, 1 << 32, _key(secret, "ip"))))


def _check_digit(digits: str) -> str:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _card(text: str, secret: bytes) -> str:
    """The issuer's first digit and the grouping stay; a valid check digit is valid again."""
    digits = re.sub(r"\D", "", text)
    valid = _check_digit(digits[:-1]) == digits[-1]
    body = digits[:-1]
    moved = recoded(body, [None] + [DIGITS] * (len(body) - 1), _key(secret, "card", str(len(digits)), digits[0]))
    # an invalid number stays invalid by the same distance, so both kinds stay apart
    off = (int(digits[-1]) - int(_check_digit(body))) % 10
    moved += _check_digit(moved) if valid else str((int(_check_digit(moved)) + off) % 10)
    left = iter(moved)
    return "".join(next(left) if c.isdigit() else c for c in text)


def _phone(text: str, secret: bytes) -> str:
    """Country code and punctuation stay."""
    keep = m.end() if (m := re.match(r"\+\d{1,3}(?=\D)|\+\d{2}", text)) else 0
    digits = re.sub(r"\D", "", text[keep:])
    moved = iter(recoded(digits, [DIGITS] * len(digits), _key(secret, "phone", text[:keep], str(len(digits)))))
    return text[:keep] + "".join(next(moved) if c.isdigit() else c for c in text[keep:])


def _secret(text: str, secret: bytes) -> str:
    if re.fullmatch(r"[0-9a-f]+", text):
        return recoded(text, [HEX] * len(text), _key(secret, "hex", str(len(text))))
    return _by_class(text, secret, "key", 4 if re.match(r"AKIA|ASIA", text) else 0)


@lru_cache(maxsize=64)
def _known(script: str) -> dict[str, str]:
    return {name.casefold(): gender for (gender, of), names in GIVEN.items() if of == script for name in names}


def _script(word: str) -> str:
    return next((unicodedata.name(c, "").split(" ")[0] for c in word if c.isalpha()), "")


def gender_of(name: str, title: str = "") -> str:
    """f, m or empty: by the title, else by the given name."""
    return _GENDER.get(title) or _known(_script(name)).get(name.split(" ")[0].casefold(), "")


def _name_part(word: str, secret: bytes) -> str:
    script = _script(word)
    known = _known(script)
    if (gender := known.get(word.casefold())) is not None:
        names = [n.casefold() for n in GIVEN[gender, script]]
        at = shifted(names.index(word.casefold()), len(names), _key(secret, "given", gender, script))
        out = GIVEN[gender, script][at]
        return out.upper() if word.isupper() and len(word) > 1 else out
    vowels, consonants = ALPHABETS.get(script, ("", ""))
    low = word.casefold() if len(word.casefold()) == len(word) else word
    classes = [vowels if c in vowels and c else consonants if c in consonants and c else None for c in low]
    if len(low) > 2 and classes[-1] == vowels:
        classes[-1] = None  # the ending often tells the gender
    form = "".join("-" if a is None else a[0] for a in classes) + "".join(c for c, a in zip(low, classes, strict=True) if a is None)
    out = recoded(low, classes, _key(secret, "name", script, form))
    while out in known:  # a lexicon name is no surrogate of another
        out = recoded(out, classes, _key(secret, "name", script, form))
    return "".join(b.upper() if a.isupper() else b for a, b in zip(word, out, strict=True))


def _name(text: str, secret: bytes) -> str:
    return re.sub(r"[^\W\d_]+", lambda m: _name_part(m[0], secret), text)


_MAKERS: dict[str, Callable[[str, bytes], str]] = {
    "email": _email, "ip": _ip, "card": _card, "phone": _phone, "key": _secret, "secret": _secret, "name": _name,
    "ssn": lambda text, secret: _by_class(text, secret, "ssn"), "iban": lambda text, secret: _by_class(text, secret, "iban", 2),
}


def _is_ipv6(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return any(c in DIGITS for c in text)


def _capitalised(words: str) -> list[str]:
    """The words up to the first that does not start with a capital."""
    out = []
    for word in words.split():
        if not word[0].isupper():
            break
        out.append(word)
    return out


def _apart(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """In order and without overlap; the earlier, then longer one wins."""
    out: list[tuple[int, int, str]] = []
    for span in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities of one text, in order and without overlap; the earlier, then longer one wins.

    A name follows a title, or is a known given name with the capitalised words behind it; its words are
    names wherever else they stand capitalised in the text.
    """
    found = []
    if "@" in text:
        found += [(*m.span(), "email") for m in _PATTERNS["email"].finditer(text)]
    if any(d in text for d in DIGITS):
        for kind in ("ip", "phone", "ssn", "card", "iban", "key"):
            found += [(*m.span(), kind) for m in _PATTERNS[kind].finditer(text)
                      if kind != "ip" or all(int(p) < 256 for p in m[0].split("."))]
        for pattern, least, most in _GROUPED_PHONES:
            found += [(*m.span(), "phone") for m in pattern.finditer(text)
                      if least <= sum(c.isdigit() for c in m[0]) <= most and not _DATE.match(m[0])]
        if ":" in text:
            found += [(*m.span(), "ip") for m in _IPV6.finditer(text) if _is_ipv6(m[0])]
    if "=" in text or ":" in text:
        found += [(*m.span(1), "secret") for m in _SECRET.finditer(text)]
    for m in _TITLE.finditer(text):
        if words := _capitalised(m[2]):
            found.append((m.start(2), m.start(2) + len(" ".join(words)), "name"))
    for m in _GIVEN.finditer(text):
        if words := _capitalised(m[1]):
            found.append((m.start(), m.start(1) + 1 + len(" ".join(words)), "name"))
    out = _apart(found)
    if parts := {w for a, b, kind in out if kind == "name" for w in text[a:b].split() if len(w) > 1}:
        # runs of such words are one mention; the spans there are stay as they are
        word = "(?:" + "|".join(map(re.escape, sorted(parts, key=len, reverse=True))) + ")"
        taken = 0
        more = []
        for m in re.finditer(rf"(?<!\w){word}(?: {word})*(?!\w)", text):
            while taken < len(out) and out[taken][1] <= m.start():
                taken += 1
            if taken == len(out) or out[taken][0] >= m.end():
                more.append((*m.span(), "name"))
        out = _apart(out + more)
    return out


def _canonical(text: str, kind: str) -> str:
    """What two mentions of one entity have in common."""
    if kind in ("card", "iban", "ssn"):
        return re.sub(r"[ -]", "", text)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", text)
    if kind == "ip" and ":" in text:
        return str(ipaddress.IPv6Address(text))
    return text.casefold() if kind in ("email", "name") else text


def replace(text: str, secret: bytes) -> tuple[str, list[tuple[int, int, str, str]], int]:
    """The text with surrogates, (start, end, type, surrogate) of its entities, and how many surrogates two of them share."""
    parts, at, entities = [], 0, []
    owners: dict[tuple[str, str], set[str]] = {}
    for start, end, kind in detect(text):
        surrogate = _MAKERS[kind](text[start:end], secret)
        group = "key" if kind == "secret" else kind
        owners.setdefault((group, _canonical(surrogate, kind)), set()).add(_canonical(text[start:end], kind))
        entities.append((start, end, kind, surrogate))
        parts += [text[at:start], surrogate]
        at = end
    return "".join([*parts, text[at:]]), entities, sum(len(o) > 1 for o in owners.values())


def with_surrogates(docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text with surrogates, entities (start, end, type, surrogate), n_collisions.

    Offsets are characters of the input text. Null text stays null and has no entities; empty text is
    kept. Equal entities get equal surrogates in all rows, whatever their order; repeated rows give
    equal results; null ids are carried along. Only id and text are read; an empty table gives no
    rows. Nothing is shuffled.
    """
    entity = T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("type", T.StringType()), T.StructField("surrogate", T.StringType()),
    ])
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("text", T.StringType()),
        T.StructField("entities", T.ArrayType(entity)), T.StructField("n_collisions", T.IntegerType()),
    ])
    key = hashlib.blake2b(secret.encode(), digest_size=32).digest()
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("type", pa.string()), ("surrogate", pa.string())]))

    def swap(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(None, [], 0) if t is None else replace(t, key) for t in batch.column("_text").to_pylist()]
        names = ("start", "end", "type", "surrogate")
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([f[0] for f in found], pa.string()),
            pa.array([[dict(zip(names, e, strict=True)) for e in f[1]] for f in found], kind),
            pa.array([f[2] for f in found], pa.int32()),
        ], names=schema.names)

    return kernel.arrow_map(docs.select(F.col(id_col), F.col(text_col).alias("_text")), swap, schema, "_text")


def shared_surrogates(replaced: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Surrogates that stand for more than one entity anywhere in the corpus: type, surrogate, n_entities. Empty when right."""
    spans = replaced.select(F.col(id_col), F.explode("entities").alias("e")).join(docs.select(id_col, text_col), id_col)
    original = F.expr(f"lower(substring({text_col}, e.start + 1, e.end - e.start))")
    plain = lambda c: F.regexp_replace(F.lower(c), r"[\s()\-]", "")
    return (
        spans.select(F.col("e.type").alias("type"), plain(F.col("e.surrogate")).alias("surrogate"), plain(original).alias("o"))
        .distinct().groupBy("type", "surrogate").agg(F.count("*").alias("n_entities")).where(F.col("n_entities") > 1)
    )
