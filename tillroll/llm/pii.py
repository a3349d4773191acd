"""Personal data replaced by keyed surrogates of the same kind and form.

A surrogate comes from a keyed permutation of all strings of its entity's form:
which characters are digits, vowels, capital letters and so on. Two entities of one
form never share a surrogate, entities of different forms can't, and none is its
own surrogate. One entity has the same surrogate in every document, also where it
is written with other separators. Names are replaced word by word, so that a family
name alone still refers to the one who was named in full. The few entities without a
letter or digit to permute get a hash, and a check over the whole corpus gives new ones
where two hashes meet.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices_by_bytes

ROUNDS = 8  # of the permutation
WIDEST = 1 << 1024  # strings of a form that are permuted as one number; its halves are then no wider than a hash
MOST_ATTEMPTS = 20
SHORT_KEY_BYTES = 16

# Forms of personal data and secrets. Earlier ones win where two overlap.
_EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+")
_KEY = re.compile(
    r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:sk|pk|rk)[-_](?:live[-_]|test[-_])?[A-Za-z0-9]{16,}|\bgh[pousr]_[A-Za-z0-9]{20,}|\bxox[abprs]-[A-Za-z0-9-]{10,}"
)
_SECRET = re.compile(
    r"\b(?:password|passwd|pwd|secret|api[_-]?key|access[_-]?key|auth[_-]?token)[\"']?\s*(?:=\s*[\"']?([^\s\"']{4,})|:\s*[\"']?(?=[^\s\"']*\d)([^\s\"']{6,}))",
    re.IGNORECASE,
)
_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_VERSION = re.compile(r"(?:\b(?:version|ver|release|rev|build)\.?:?|\bv\.?)\s*$", re.IGNORECASE)  # before a number like an address
_PHONE = re.compile(
    r"(?<![\w+])(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)"
    r"|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]|\.\d)"
    r"|(?<![\w.-])(?<!\d )[2-9]\d{2} [2-9]\d{2} \d{4}(?![\w-]| \d|\.\d)"
    r"|(?<![\w.-])(?<!\d )0\d{2,4} \d{3,4} \d{3,4}(?![\w-]| \d|\.\d)"
)
_SSN = re.compile(r"(?<![\w-])(?:\d{3}-\d{2}-\d{4}|(?<!\d )(?!000|666|9)\d{3} \d{2} \d{4}(?! \d))(?![\w-])")
_CARD = re.compile(r"(?<![\w-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{13,19})(?![\w-])")
_NAME = re.compile(
    r"\b(Mrs?|Ms|Miss|Dr|Herrn?|Frau|Monsieur|Madame|Mme|Mlle|Señora?|Sra?|Srta)\.?[  ]"
    r"([^\W\d_a-zß-öø-ÿ][^\W\d_]+(?:[ -][^\W\d_a-zß-öø-ÿ][^\W\d_]+)?)"
)
_TITLES = ("Mr", "Ms", "Miss", "Dr", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Mlle", "Señor", "Sr")
_SECRET_WORDS = re.compile(r"pass(?:word|wd)|pwd|secret|api[_-]?key|access[_-]?key|auth[_-]?token", re.IGNORECASE)
_RESERVED = ("example.com", "example.net", "example.org", ".example", ".invalid", ".test")
_NOBODY = "example"

# Characters that stand for each other.
_CLASSES = [
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
]
_SOUNDS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", *_CLASSES[3:]]
_LEADING = ["01", "23456789"]
_HEX_CLASSES = {False: ["0123456789abcdef"], True: ["0123456789ABCDEF"]}


def _by_character(classes: list[str]) -> dict[str, str]:
    return {c: own for own in classes for c in own}


_ANY, _NAMED = _by_character(_CLASSES), _by_character(_SOUNDS)
_DIGITS = _by_character(_CLASSES[:1])


def find(text: str) -> list[tuple[int, int, str]]:
    """`(start, end, kind)` of every entity, in order, none overlapping."""
    found: list[tuple[int, int, str]] = []

    def add(kind: str, pattern: re.Pattern, *groups: int) -> None:
        for m in pattern.finditer(text):
            span = next(m.span(g) for g in (groups or (0,)) if m.group(g) is not None)
            found.append((*span, kind))

    if "@" in text:
        add("email", _EMAIL)
    if _SECRET_WORDS.search(text):
        add("secret", _SECRET, 1, 2)
    if _DIGIT.search(text):
        add("key", _KEY)
        add("hex", _HEX)
        add("iban", _IBAN)
        for m in _IP.finditer(text):
            if _octets(m[0]) and not _VERSION.search(text, max(0, m.start() - 16), m.start()):
                found.append((*m.span(), "ip"))
        add("phone", _PHONE)
        add("ssn", _SSN)
        # without separators only a right check digit tells a card from any other number
        found += [(*m.span(), "card") for m in _CARD.finditer(text) if m[1] or _luhn(m[0][:-1]) == int(m[0][-1])]
    if "::" in text or text.count(":") > 6:
        found += [(*m.span(), "ipv6") for m in _IPV6.finditer(text) if _is_ipv6(m[0])]
    if any(title in text for title in _TITLES):
        found += _names(text)
    kept: list[tuple[int, int, str]] = []
    for span in found:  # in order of priority
        if all(span[1] <= a or b <= span[0] for a, b, _ in kept):
            kept.append(span)
    return sorted(kept)


_DIGIT = re.compile(r"[0-9]")
_NAME_WORD = re.compile(r"[^\W\d_]+")


def _names(text: str) -> list[tuple[int, int, str]]:
    """Each word of the names that stand behind a title, wherever it stands in the text."""
    words = {word for m in _NAME.finditer(text) for word in _NAME_WORD.findall(m[2])}
    return [(*m.span(), "name") for m in _NAME_WORD.finditer(text) if m[0] in words] if words else []


def _is_ipv6(text: str) -> bool:
    """An address, and not just a few short words between colons."""
    if sum(map(bool, text.split(":"))) < 3:
        return False
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def _octets(text: str) -> bool:
    return all(int(part) < 256 for part in text.split("."))


_SEPARATED = ("phone", "card", "ssn", "iban")  # kinds that may be written with other separators, or digits of another script


def _plain(kind: str, text: str) -> str:
    """What the entity is, whatever separators and letter case it is written with."""
    if kind in _SEPARATED:
        return re.sub(r"[^0-9A-Za-z]", "", re.sub(r"\d", lambda m: str(int(m[0])), text))  # digits of any script
    if kind == "email":
        return text.lower()
    if kind == "ip":
        return str(ipaddress.IPv4Address(".".join(str(int(p)) for p in text.split("."))))
    if kind == "ipv6":
        return str(ipaddress.IPv6Address(text))
    return text


def usable_key(key: bytes) -> bytes:
    """The key itself, or its digest if it is longer than the hash takes."""
    return key if len(key) <= 64 else hashlib.blake2b(key).digest()


# Ranges of addresses that are no one's own; what is in one stays in it.
_RANGES = {
    "ip": [
        ipaddress.IPv4Network(n)
        for n in (
            "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
            "192.0.2.0/24", "192.168.0.0/16", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
        )
    ],
    "ipv6": [ipaddress.IPv6Network(n) for n in ("::/32", "2001:db8::/32", "fc00::/7", "fe80::/10", "ff00::/8")],
}


def _new_address(kind: str, plain: str, key: bytes) -> str:
    """Another address of the same range; a public one becomes a public one."""
    whole = ipaddress.IPv4Address if kind == "ip" else ipaddress.IPv6Address
    own = next((r for r in _RANGES[kind] if whole(plain) in r), None)
    if own:
        first = int(own.network_address)
        return str(whole(first + permute(key, f"{kind}{own}", int(whole(plain)) - first, own.num_addresses)))
    x = int(whole(plain))
    while True:  # on along the permutation's cycle, which stays a permutation
        x = permute(key, kind, x, 1 << whole(0).max_prefixlen)
        if not any(whole(x) in r for r in _RANGES[kind]):
            return str(whole(x))


def _number(key: bytes, *parts: object) -> int:
    data = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=64).digest(), "big")


def _steps(key: bytes, form: str, x: int, size: int, back: bool) -> int:
    """One pass of a keyed permutation of 0..size-1, or of its inverse."""
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(x, b)  # left < a, right < b
        for i in range(ROUNDS)[:: -1 if back else 1]:
            sign = -1 if back else 1
            if i % 2:
                left = (left + sign * _number(key, form, size, i, right)) % a
            else:
                right = (right + sign * _number(key, form, size, i, left)) % b
        x = left * b + right
        if x < size:  # else go on from there, which keeps it a permutation
            return x


def permute(key: bytes, form: str, x: int, size: int) -> int:
    """A keyed permutation of 0..size-1 that leaves no number in its place (size over 1)."""
    shift = 1 + _number(key, form, size) % (size - 1)
    return _steps(key, form, (_steps(key, form, x, size, False) + shift) % size, size, True)


def _drawn(key: bytes, sizes: np.ndarray, *parts: bytes) -> np.ndarray:
    """A number below each size, from a hash of the parts."""
    seed = hashlib.blake2b(b"\x1f".join(parts), key=key).digest()
    return np.frombuffer(hashlib.shake_256(seed).digest(4 * len(sizes)), dtype="<u4") % sizes


def permute_places(key: bytes, form: str, places: list[int], sizes: list[int]) -> list[int]:
    """`permute` for strings too long to be one number: a number below each size, never all as before.

    Every new number depends on all the given ones, and the work is in proportion to the length.
    """
    size, x = np.array(sizes, dtype=np.int64), np.array(places, dtype=np.int64)
    name = hashlib.blake2b(form.encode(), key=key).digest()
    left, right = slice(0, len(x) // 2), slice(len(x) // 2, None)

    def steps(x: np.ndarray, back: bool) -> np.ndarray:
        x = x.copy()
        for i in range(ROUNDS)[:: -1 if back else 1]:
            turned, by = (left, right) if i % 2 else (right, left)
            turn = _drawn(key, size[turned], name, bytes([i]), x[by].astype(np.uint8).tobytes())
            x[turned] = (x[turned] + (-turn if back else turn)) % size[turned]
        return x

    shift = _drawn(key, size, name)
    shift[0] = 1 + shift[0] % (size[0] - 1)
    return steps((steps(x, False) + shift) % size, True).tolist()


def _permuted(
    key: bytes | None, kind: str, text: str, classes: dict[str, str], fixed: set[int] = frozenset(), leading: set[int] = frozenset()
) -> str | None:
    """The text with the characters of known classes permuted; None if there is nothing to permute.

    key: None only asks whether there is.
    fixed: places that stay. leading: digits that stay 0 or 1, or stay above.
    """
    owns = [None if i in fixed else classes.get(c) for i, c in enumerate(text)]
    for i in leading - fixed:
        owns[i] = next(own for own in _LEADING if text[i] in own)
    form = kind + "\x1e" + "".join(own[0] if own else f"\x1d{c}" for own, c in zip(owns, text))
    x, size = 0, 1
    for own, c in zip(owns, text):
        if own:
            x = x * len(own) + own.index(c)
            size *= len(own)
            if size > WIDEST:
                break
    if size < 2:
        return None
    if key is None:
        return text  # there is something to permute
    out = list(text)
    if size > WIDEST:
        at = [i for i, own in enumerate(owns) if own]
        new = permute_places(key, form, [owns[i].index(text[i]) for i in at], [len(owns[i]) for i in at])
        for i, place in zip(at, new):
            out[i] = owns[i][place]
        return "".join(out)
    x = permute(key, form, x, size)
    for i in range(len(text) - 1, -1, -1):
        if owns[i]:
            x, place = divmod(x, len(owns[i]))
            out[i] = owns[i][place]
    return "".join(out)


def _luhn(digits: str) -> int:
    """The check digit of the given digits."""
    doubled = [int(c) * (2 if i % 2 == 0 else 1) for i, c in enumerate(reversed(digits))]
    return -sum(d - 9 if d > 9 else d for d in doubled) % 10


def _new_plain(kind: str, plain: str, key: bytes | None) -> str | None:
    if kind == "email":
        domain_at = plain.index("@") + 1
        labels = plain[domain_at:].split(".")
        reserved = next((r for r in _RESERVED if plain.endswith(r)), None)
        tail = len(reserved) if reserved else len(labels[-1])
        new = _permuted(key, kind, plain, _ANY, set(range(len(plain) - tail, len(plain))))
        # The new domain may be somebody's; below a reserved name it is nobody's.
        return new if reserved or new is None else f"{new}.{_NOBODY}"
    if kind == "card":
        body = _permuted(key, f"card{(int(plain[-1]) - _luhn(plain[:-1])) % 10}", plain[:-1], _DIGITS)
        if key is None:
            return body
        return body + str((_luhn(body) + int(plain[-1]) - _luhn(plain[:-1])) % 10)
    if kind in _RANGES:
        return plain if key is None else _new_address(kind, plain, key)
    if kind == "phone":
        area = len(plain) - 10  # the country code before it stays
        leading = {area, area + 3} if area >= 0 else set()  # no area or exchange begins with 0 or 1
        return _permuted(key, kind, plain, _DIGITS, set(range(max(0, area))), leading)
    if kind == "iban":
        return _permuted(key, kind, plain, _ANY, {0, 1})
    if kind == "key":
        prefix = re.match(r"AKIA|ASIA|(?:sk|pk|rk)[-_](?:live[-_]|test[-_])?|gh\w_|xox\w-", plain)[0]
        return _permuted(key, kind, plain, _ANY, set(range(len(prefix))))
    if kind == "hex":
        return _permuted(key, kind, plain, _by_character(_HEX_CLASSES[any(c in "ABCDEF" for c in plain)]))
    if kind == "name":  # each word's last letter, which often tells the gender, stays
        ends = {i for i in range(len(plain)) if i + 1 == len(plain) or not plain[i + 1].isalpha()}
        return _permuted(key, kind, plain, _NAMED, ends)
    return _permuted(key, kind, plain, _ANY)


def _hashed(kind: str, plain: str, key: bytes, attempt: int) -> str:
    """For an entity without anything to permute: letters from a hash, one capital as in a name."""
    n = _number(key, "hashed", kind, plain, attempt)
    letters = []
    for i in range(10):
        n, place = divmod(n, len(_SOUNDS[1 - i % 2]))
        letters.append(_SOUNDS[1 - i % 2][place])
    return "".join(letters).capitalize()


def surrogate(kind: str, text: str, key: bytes, attempts: dict[str, int] = {}) -> str:  # noqa: B006
    """The entity's replacement, written with its separators and letter case."""
    plain = _plain(kind, text)
    new = _new_plain(kind, plain, key)
    if new is None:
        return _hashed(kind, plain, key, attempts.get(_digest(kind, plain, key), 0))
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(text, new)) + new[len(text) :]
    if kind in _RANGES or len(new) == len(text) and (text.isascii() or kind not in _SEPARATED):
        return new
    rest = iter(new)
    return "".join(_written(next(rest), c) if c.isdecimal() or c.isascii() and c.isalnum() else c for c in text)


def _written(new: str, old: str) -> str:
    """A digit in the script of the one that it replaces; anything else as it is."""
    return new if old.isascii() else chr(ord(old) - int(old) + int(new))


def _digest(kind: str, plain: str, key: bytes) -> str:
    return hashlib.blake2b(f"{kind}\x1f{plain}".encode(), key=key, digest_size=SHORT_KEY_BYTES).hexdigest()


def entities(
    docs: DataFrame, key: bytes, attempts: dict[str, int] = {}, text: str = "text", hashed_only: bool = False  # noqa: B006
) -> DataFrame:
    """`kind, entity, surrogate` of every occurrence; `entity` is a keyed digest, never the original.

    `hashed_only` leaves out entities with something to permute.
    """
    key = usable_key(key)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "text"):
            rows = {}
            for value in batch.column(0).to_pylist():
                for a, b, kind in find(value or ""):
                    plain = _plain(kind, value[a:b])
                    if hashed_only and _new_plain(kind, plain, None) is not None:
                        continue
                    rows[kind, _digest(kind, plain, key)] = _plain(kind, surrogate(kind, value[a:b], key, attempts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.string()), pa.array([e for _, e in rows], pa.string()), pa.array(list(rows.values()), pa.string())],
                names=["kind", "entity", "surrogate"],
            )

    return docs.select(F.col(text).alias("text")).mapInArrow(found, "kind string, entity string, surrogate string")


def collisions(found: DataFrame) -> DataFrame:
    """`kind, surrogate, entities, least`: surrogates that several entities share."""
    return (
        found.groupBy("kind", "surrogate", "entity")
        .agg(F.lit(1).alias("one"))  # hot entities are one row per task from here on
        .groupBy("kind", "surrogate")
        .agg(F.count("*").alias("n"), F.min("entity").alias("least"), F.max("entity").alias("largest"))
        .filter(F.col("n") > 1)
    )


def distinct_attempts(docs: DataFrame, key: bytes, text: str = "text") -> dict[str, int]:
    """For hashed surrogates that meet: which attempt each entity but the least takes.

    Permuted surrogates cannot meet, and hashes of ten letters meet about once per
    10^11 pairs, so what reaches the driver is next to nothing at any size.
    """
    attempts: dict[str, int] = {}
    if entities(docs, key, text=text, hashed_only=True).isEmpty():
        return attempts  # nothing but permuted ones
    for _ in range(MOST_ATTEMPTS):
        met = collisions(entities(docs, key, attempts, text)).select("least", "largest").collect()
        if not met:
            return attempts
        for row in met:
            tried = {e: attempts.get(e, 0) for e in (row["largest"], row["least"])}
            attempts[min(tried, key=tried.get)] = min(tried.values()) + 1  # a permuted one can't move; then the other does
    raise RuntimeError("surrogates still meet; use another key")


def replaced_text(text: str | None, key: bytes, attempts: dict[str, int]) -> tuple[str | None, list]:
    """The text with surrogates, and the entities that were found in it."""
    spans = find(text) if text else []
    if not spans:
        return text, spans
    parts, at = [], 0
    for a, b, kind in spans:
        parts += [text[at:a], surrogate(kind, text[a:b], key, attempts)]
        at = b
    return "".join([*parts, text[at:]]), spans


def replace(
    docs: DataFrame, key: bytes, attempts: dict[str, int] = {}, doc_id: str = "doc_id", text: str = "text"  # noqa: B006
) -> DataFrame:
    """A row per input row: `doc_id, text, n_entities, kinds`, entities replaced.

    `kinds` are the distinct kinds found, sorted and joined by commas. A null text
    stays null and an empty one empty; repeated rows stay repeated; other columns
    are not read.
    """
    key = usable_key(key)
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "text"):
            texts, counts, kinds = [], [], []
            for value in batch.column(1).to_pylist():
                new, spans = replaced_text(value, key, attempts)
                texts.append(new)
                counts.append(len(spans))
                kinds.append(",".join(sorted({k for _, _, k in spans})))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.string())],
                names=["doc_id", "text", "n_entities", "kinds"],
            )

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(replaced, f"doc_id {kind}, text string, n_entities long, kinds string")


def replace_personal_data(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`replace` after the check over the whole corpus that no two entities share a surrogate."""
    return replace(docs, key, distinct_attempts(docs, key, text), doc_id, text)


def replace_in_rows(docs: DataFrame, key: bytes, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns, with entities replaced in `text`, and `n_chars` (if there) counted again where one was."""
    attempts = distinct_attempts(docs, key, text)
    key = usable_key(key)
    at = docs.columns.index(text)
    count_at = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, text):
            columns = batch.columns
            pairs = [replaced_text(value, key, attempts) for value in columns[at].to_pylist()]
            columns[at] = pa.array([new for new, _ in pairs], columns[at].type)
            if count_at is not None:
                before = columns[count_at].to_pylist()
                after = [len(new) if spans else n for (new, spans), n in zip(pairs, before)]
                columns[count_at] = pa.array(after, columns[count_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(replaced, docs.schema)
