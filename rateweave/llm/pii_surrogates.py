"""PII surrogates: detected entities are replaced by keyed stand-ins of the same kind and format.

A stand-in is drawn from HMAC-SHA256 of the kind, the entity and an attempt
number, so the same entity gets the same stand-in everywhere without a lookup
(coreference).  Distinctness is checked over the whole corpus: the distinct
entities' stand-ins are shuffled by value, and wherever two entities share
one, or a stand-in equals an entity that occurs, all but the smallest entity
move to the next attempt, until none is left.  Only those that moved (a few,
unless a format has little room) are joined back to the texts they occur in.

The distinct entities are written to the job's shared folder while it runs;
treat that folder as confidential.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.llm._common import free_name, stored

# Honorifics with the gender they tell, and common given names by gender and script.
TITLES = {
    "Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f",
    "Sra": "f", "Госпожа": "f", "Κυρία": "f", "Dr": "n", "Prof": "n", "Professor": "n",
}
GIVEN = {
    "m": "James John Robert Michael William David Richard Thomas Charles Daniel Pierre Jean Hans Karl Juan Carlos José "
    "Иван Сергей Дмитрий Алексей Γιώργος Νίκος",
    "f": "Mary Patricia Jennifer Linda Elizabeth Susan Sarah Karen Nancy Anna Marie Claire Greta Heidi María Carmen "
    "Анна Мария Ольга Елена Μαρία Ελένη",
}
# Syllables that stand-in names are made of, and the ends that mark a given name's gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se ta te ti "
    "to va ve vi".split(),
    "cyrillic": "ба бе бо ва ве ви га го да де до ка ке ла ле ли ма ме ми на не ни па ра ре ро са се та те".split(),
    "greek": "βα γα δα δε δι κα κε λα λε λι μα με μι να νε νι πα ρα ρε ρο σα σε τα τε".split(),
}
ENDS = {
    "latin": {"m": "n", "f": "na", "n": "l", "": "r"},
    "cyrillic": {"m": "н", "f": "на", "n": "л", "": "р"},
    "greek": {"m": "νος", "f": "να", "n": "λ", "": "ρης"},
}

# Characters of a bank account number by its country; other countries' may have any length.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

_UPPER, _LOWER = "A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆ-Ώ", "a-zß-öø-ÿа-яёα-ώά-ώ"
_NAME_WORD = f"[{_UPPER}][{_LOWER}]+(?:[-'’][{_UPPER}]?[{_LOWER}]+)?"
_GENDER = {name: g for g, names in GIVEN.items() for name in names.split()}
_PATTERNS = {
    "phone": re.compile(
        r"(?<![\w+.-])(?:(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+1 ?\d{10}"
        r"|\+[2-9]\d{0,2}(?:[ .-]?(?:\(\d{1,4}\)|\d{2,4})){2,5})(?!\w|\.\d)"
    ),
    "card": re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,}(?!\w)"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?=((?: ?[A-Z0-9]){11,30}))"),
    "secret": re.compile(
        r"\bAKIA([0-9A-Z]{16})\b"
        r"|(?i:(?<![^\W_])(?:token|secret|password|passwd|api[_-]?key)[\"']?\s*[=:]\s*[\"']?)([A-Za-z0-9+/_-]{8,})"
    ),
}
# Card numbers as they are usually grouped, and accounts of any country in groups of four.
_CARD_GROUPS = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5}")
_IBAN_GROUPS = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
# An address's longest local part and domain; what follows the sign, and the ends it may have.
_LOCAL, _DOMAIN = 64, 255
_DOMAIN_RUN, _TOP_LEVEL = re.compile(r"[A-Za-z0-9][\w.-]*"), re.compile(r"\.[A-Za-z]{2,}")
#: Digits of a card number.
_CARD_DIGITS = range(13, 20)
_DIGITS, _WORD = re.compile(r"\d+"), re.compile(r"\w")
_TITLED = re.compile(rf"\b({'|'.join(TITLES)})\b\.?[ \u00a0]+({_NAME_WORD}(?:[ \u00a0]{_NAME_WORD}){{0,2}})")
_GIVEN_FIRST = re.compile(rf"\b((?:{'|'.join(_GENDER)})[ \u00a0]{_NAME_WORD})")
_HINTS = [*"0123456789@", *TITLES, *_GENDER]
# In case-folded texts; whatever the pattern accepts holds one of them.
_SECRET_HINTS = ("akia", "token", "secret", "passw", "key")


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str  # with gender and script for names
    canonical: str  # the same for all spellings of the same entity


def luhn_digit(payload: str) -> str:
    """The check digit that ends a card number."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_check(account: str) -> str:
    """The two check digits of an international bank account number."""
    digits = "".join(str(int(c, 36)) for c in account[4:] + account[:2] + "00")
    return f"{98 - int(digits) % 97:02d}"


def _script(word: str) -> str:
    c = word[0].lower()
    return "cyrillic" if "а" <= c <= "я" or c == "ё" else "greek" if "ά" <= c <= "ώ" else "latin"


def _name_parts(start: int, words: str, gender: str) -> Iterator[Entity]:
    parts = list(re.finditer(_NAME_WORD, words))
    for i, m in enumerate(parts):
        word = m[0]
        surname = i == len(parts) - 1
        kind = "surname:" if surname else f"given:{_GENDER.get(word, gender)}:"
        yield Entity(start + m.start(), start + m.end(), kind + _script(word), word.lower())


def _ibans(text: str) -> Iterator[Entity]:
    """Bank accounts, each of the length that its country fixes or else of whole groups."""
    done = 0
    for m in _PATTERNS["iban"].finditer(text):
        if m.start() < done:
            continue
        fixed, groups = IBAN_LENGTHS.get(m[0][:2]), _IBAN_GROUPS.match(text, m.start())
        whole = groups.end() if groups else 0
        ends = [e for e in range(m.end(1), m.end(), -1) if text[e - 1] != " " and not _WORD.match(text, e)]
        runs = {e: text[m.start() : e].replace(" ", "") for e in ends}
        tried = [e for e in ends if len(runs[e]) == fixed] + [e for e in ends if e == whole or e < whole and not fixed]
        for end in tried:
            if len(runs[end]) >= 15 and iban_check(runs[end]) == runs[end][2:4]:
                yield Entity(m.start(), end, "iban", runs[end])
                done = end
                break


def _emails(text: str) -> Iterator[Entity]:
    """Addresses, found from their ``@``: at most 64 characters before it and 255 after it are looked at."""
    done, at = 0, text.find("@")
    while at >= 0:
        start, lowest = at, max(done, at - _LOCAL - 1)
        while start > lowest and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
            start -= 1
        run = _DOMAIN_RUN.match(text, at + 1, at + 2 + _DOMAIN)
        if 0 < at - start <= _LOCAL and text[at - 1] != "." and run and len(run[0]) <= _DOMAIN:
            tops = list(_TOP_LEVEL.finditer(run[0]))
            if tops:
                done = at + 1 + tops[-1].end()
                yield Entity(start, done, "email", text[start:done].lower())
        at = text.find("@", max(at + 1, done))


def _checked(digits: str) -> tuple[list[int], list[int]]:
    """Running sums of a card's check: with the digits at even places doubled, and at odd ones."""
    plain = [int(d) for d in digits]
    doubled = [2 * d - 9 if d > 4 else 2 * d for d in plain]
    even, odd = plain[:], plain[:]
    even[::2], odd[1::2] = doubled[::2], doubled[1::2]
    return [0, *accumulate(even)], [0, *accumulate(odd)]


def _cards(text: str) -> Iterator[tuple[int, Entity]]:
    """Every run of whole groups of digits with a card number's length and check digit; they may overlap.

    0: grouped as card numbers usually are, 1: with no more groups beside it, 2: any other.
    """
    for m in _PATTERNS["card"].finditer(text):
        groups = [g.span() for g in _DIGITS.finditer(text, *m.span())]
        digits = "".join([text[a:z] for a, z in groups])
        sums, ends = _checked(digits), list(accumulate(z - a for a, z in groups))
        for i, (start, _) in enumerate(groups):
            first = ends[i - 1] if i else 0
            for j in range(i, min(len(groups), i + _CARD_DIGITS.stop)):
                last = ends[j]
                if last - first >= _CARD_DIGITS.stop:
                    break
                # The last digit is not doubled, the one before it is.
                if last - first in _CARD_DIGITS and (sums[last % 2][last] - sums[last % 2][first]) % 10 == 0:
                    end = groups[j][1]
                    rank = 0 if _CARD_GROUPS.fullmatch(text, start, end) else 1 if (start, end) == m.span() else 2
                    yield rank, Entity(start, end, "card", digits[first:last])


def _apart(found: list[Entity], fixed: list[Entity]) -> list[Entity]:
    """Of those that overlap, the one that begins first, then the longer one; none that overlaps ``fixed`` (in order and apart)."""
    starts, taken = [f.start for f in fixed], []
    for e in sorted(found, key=lambda e: (e.start, -e.end, e.kind)):
        before = bisect_left(starts, e.end)
        if (not taken or e.start >= taken[-1].end) and (not before or fixed[before - 1].end <= e.start):
            taken.append(e)
    return taken


def detect(text: str | None) -> list[Entity]:
    """Entities of a text, in order and apart from each other; none for a null text.

    E-mail addresses (up to 64 characters before the sign and 255 after it; a
    longer run is no address), international and North American phone numbers, card
    numbers (13 to 19 digits) and bank accounts (IBAN) with right check
    digits, IPv4 addresses, US social security numbers, credentials, and names after an honorific or with a known given
    name.  Where two overlap, the one that begins first, then the longer one.
    Digits or capitals beside a card number or account don't hide it: any run
    of whole groups may be one.  Unusually grouped card numbers among other
    digits are looked for where nothing else was found.
    """
    if not text:
        return []
    folded = text.casefold()
    secrets = any(h in folded for h in _SECRET_HINTS)
    if not secrets and not any(h in text for h in _HINTS):
        return []
    found, inner = [], []
    digits = any(d in text for d in "0123456789")
    if "@" in text:
        found += _emails(text)
    if digits:
        ibans, cards = list(_ibans(text)), list(_cards(text))
        usual = _apart([e for rank, e in cards if rank == 0], ibans)
        found += ibans + usual + _apart([e for rank, e in cards if rank == 1], usual)
        inner = [e for rank, e in cards if rank == 2]
        for kind in ("phone", "ssn"):
            for m in _PATTERNS[kind].finditer(text):
                plain = re.sub(r"\D", "", m[0])
                if kind == "phone" and len(plain) < 8:
                    continue
                if kind == "phone" and len(plain) == 10 and "+" not in m[0]:
                    plain = "1" + plain  # the same number with and without its country
                found.append(Entity(m.start(), m.end(), kind, plain))
        found += [Entity(m.start(), m.end(), "ip", m[0]) for m in _PATTERNS["ip"].finditer(text)]
    if secrets:
        for m in _PATTERNS["secret"].finditer(text):
            group = 1 if m[1] else 2
            found.append(Entity(m.start(group), m.end(group), "secret", m[group]))
    if any(t in text for t in TITLES):
        for m in _TITLED.finditer(text):
            found += _name_parts(m.start(2), m[2], TITLES[m[1]])
    if any(g in text for g in _GENDER):
        for m in _GIVEN_FIRST.finditer(text):
            found += _name_parts(m.start(1), m[1], "n")
    apart = _apart(found, [])
    return sorted(apart + _apart(inner, apart), key=lambda e: e.start) if inner else apart


class _Stream:
    """Numbers below a bound from a keyed hash, as many as are asked for."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.seed, self.block, self.left = key, "\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"), 0, b""

    def below(self, bound: int) -> int:
        if len(self.left) < 4:
            self.left = hmac.new(self.key, self.seed + b"\x00%d" % self.block, hashlib.sha256).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % bound


def _same_classes(text: str, stream: _Stream) -> str:
    """Each digit another digit, each letter another letter of its case and script; signs stay."""
    out = []
    for c in text:
        if c.isdigit():
            out.append("0123456789"[stream.below(10)])
        elif c.isalpha():
            first, size = {"cyrillic": ("а", 32), "greek": ("α", 25)}.get(_script(c), ("a", 26))
            letter = chr(ord(first) + stream.below(size))
            out.append(letter.upper() if c.isupper() else letter)
        else:
            out.append(c)
    return "".join(out)


def _hex_like(text: str) -> bool:
    return re.fullmatch(r"(?=.*\d)(?:[0-9a-f]+|[0-9A-F]+)", text) is not None


def stand_in(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The canonical form of an entity's stand-in.

    A format's own room is used first; from the eighth attempt on, e-mail
    addresses and names grow by a character or syllable every fourth attempt,
    and private addresses may become any, so that an attempt that is free
    always comes.
    """
    stream = _Stream(key, kind, canonical, attempt)
    more = max(0, (attempt - 4) // 4)
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        body, _, top = domain.rpartition(".")
        # A domain has one stand-in, whoever writes from it.
        return f"{_same_classes(local + 'a' * more, stream)}@{_same_classes(body, _Stream(key, 'domain', domain))}.{top}"
    if kind == "phone":
        code = 1 if canonical[0] in "17" else 2  # the country's digits stay
        return canonical[:code] + _same_classes(canonical[code:], stream)
    if kind == "card":
        payload = canonical[0] + _same_classes(canonical[1:-1], stream)
        return payload + luhn_digit(payload)
    if kind == "iban":
        account = canonical[:2] + "00" + _same_classes(canonical[4:], stream)
        return canonical[:2] + iban_check(account) + account[4:]
    if kind == "ip":
        octets = canonical.split(".")
        kept = 0
        if attempt < 8:
            kept = 1 if octets[0] in ("10", "127") else 2 if octets[:2] == ["192", "168"] else 0
            kept = 2 if octets[0] == "172" and 16 <= int(octets[1]) < 32 else kept
        return ".".join(octets[:kept] + [str(stream.below(254) + 1) for _ in octets[kept:]])
    if kind == "secret" and _hex_like(canonical):
        digits = "0123456789ABCDEF" if canonical.upper() == canonical else "0123456789abcdef"
        return "".join(digits[stream.below(16)] for _ in canonical)
    if ":" in kind:
        role, *gender, script = kind.split(":")
        syllables = SYLLABLES[script]
        count = (2 if role == "given" else 3) + more
        return "".join(syllables[stream.below(len(syllables))] for _ in range(count)) + ENDS[script]["".join(gender)]
    return _same_classes(canonical, stream)


def rendered(written: str, kind: str, surrogate: str) -> str:
    """A stand-in written as the entity was: its punctuation and case."""
    if kind == "iban":
        letters = iter(surrogate)
        return "".join(c if c == " " else next(letters) for c in written)
    if kind in ("phone", "card", "ssn"):
        digits = iter(surrogate[-sum(c.isdigit() for c in written) :])
        return "".join(next(digits) if c.isdigit() else c for c in written)
    if kind == "secret" or kind == "ip":
        return surrogate
    if written.isupper():
        return surrogate.upper()
    return surrogate.title() if ":" in kind and written[0].isupper() else surrogate


def rewrite(text: str | None, key: bytes, attempts: dict[str, int]) -> tuple[str | None, int]:
    """The text with every entity replaced, and their number.  ``attempts``: by
    ``kind NUL canonical``, for entities that are past their first."""
    entities = detect(text)
    if not entities:
        return text, 0
    out, at = [], 0
    for e in entities:
        own = stand_in(key, e.kind, e.canonical, attempts.get(f"{e.kind}\x00{e.canonical}", 0))
        out += [text[at : e.start], rendered(text[e.start : e.end], e.kind, own)]
        at = e.end
    return "".join(out) + text[at:], len(entities)


def mentions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct ``(text_hash, kind, canonical)``: the entities of every text, copies counted once."""

    def run(batches):
        for batch in batches:
            found = {
                (h, e.kind, e.canonical)
                for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for e in detect(text)
            }
            columns = list(zip(*sorted(found))) or [(), (), ()]
            types = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["text_hash", "kind", "canonical"])

    rows = docs.select(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    return rows.mapInArrow(run, "text_hash bigint, kind string, canonical string").distinct()


def moved_entities(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, canonical, attempt)`` of the distinct entities that can't have their first stand-in.

    Each round settles, for every stand-in that is no entity of the corpus and
    not yet taken, the smallest entity that drew it; the others draw again.
    """

    @F.pandas_udf("string")
    def draw(kind: pd.Series, canonical: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([stand_in(key, *row) for row in zip(kind, canonical, attempt)], dtype=object)

    originals = entities.select("kind", F.col("canonical").alias("surrogate"))
    waiting, settled = entities.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = stored(waiting.withColumn("surrogate", draw("kind", "canonical", "attempt")), "pii-drawn")
        if settled is not None and drawn.isEmpty():
            return settled.where(F.col("attempt") > 0).select("kind", "canonical", "attempt")
        free = drawn.join(originals, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["kind", "surrogate"], "left_anti")
        winners = free.groupBy("kind", "surrogate").agg(F.min(F.struct("canonical", "attempt")).alias("w"))
        won = stored(winners.select("kind", "surrogate", "w.canonical", "w.attempt"), "pii-settled")
        settled = won if settled is None else settled.unionByName(won)
        waiting = drawn.join(won, ["kind", "canonical"], "left_anti").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))


def surrogates(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text_col`` replaced by its stand-in.

    Whoever knows ``key`` can tell which stand-in an entity gets: keep it
    secret.  Null texts stay null, texts without an entity stay as they are,
    repeated rows stay equal; an empty table gives an empty one.  Texts of any
    length are read whole, in time linear in their length; a task holds a
    batch of them.  With ``count_col`` a column tells how many were replaced.
    """
    found = stored(mentions(docs, text_col), "pii-mentions")
    moved = moved_entities(found.select("kind", "canonical").distinct(), key)
    named = F.concat_ws("\x00", "kind", "canonical")
    changes = found.join(moved, ["kind", "canonical"]).groupBy("text_hash")
    changes = changes.agg(F.map_from_entries(F.collect_list(F.struct(named, "attempt"))).alias("attempts"))
    # Written, so that its true size decides how it is joined: nearly always it is small enough to broadcast.
    changes = stored(changes, "pii-changes")

    @F.pandas_udf("text string, n int")
    def replace(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, attempts in batches:
            rows = [rewrite(t, key, dict(a) if a is not None else {}) for t, a in zip(texts, attempts)]
            yield pd.DataFrame({"text": [r[0] for r in rows], "n": pd.Series([r[1] for r in rows], dtype="int32")})

    hashed, taken = free_name(docs, "text_hash"), free_name(docs, "attempts")
    changes = changes.select(F.col("text_hash").alias(hashed), F.col("attempts").alias(taken))
    rows = docs.withColumn(hashed, F.xxhash64(text_col)).join(changes, hashed, "left")
    done = free_name(docs, "replaced")
    rows = rows.withColumn(done, replace(F.col(text_col), F.col(taken)))
    out = [F.col(f"{done}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*out, *([F.col(f"{done}.n").alias(count_col)] if count_col else []))
