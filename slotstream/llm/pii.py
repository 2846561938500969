"""Personal data: detection, and surrogates in place of what is found.

A surrogate is of its entity's kind and format: digits stand for digits, letters for letters
of the same case, separators stay; country codes, card issuers, check digits, the sex of given
names and endings of Slavic surnames are kept. It is made by a keyed bijection of the values of
one format (a Feistel network with cycle walking), turned so that no value stands for itself:

* one entity has one surrogate wherever and however it is written (coreference): letter case in
  e-mail addresses and separators in numbers do not matter;
* two entities never share a surrogate (distinctness): within a format by the bijection, and
  across formats by a check over all documents, after which those that meet are drawn again.

`collisions` counts, over a whole corpus, surrogates that meet before that, and entities with more
than one surrogate.

Detected: e-mail and IPv4 addresses, phone, card, social security and IBAN numbers, passwords and
tokens after their name, cloud access keys, and person names (a title and a name, or a known given
name and a surname; Latin and Cyrillic script). Digits may be of any script and keep it. Phone
numbers have 9 to 15 digits in groups, see `is_phone`; without +, parentheses or a leading 0, ten
digits in pairs are taken for other numbers.

Defined cases: NULL text stays NULL and has no entities; texts without an entity stay as they are.
Repeated rows and NULL ids are treated like any other. An empty table gives no rows.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.session import materialise
from slotstream.llm.tables import read, slices, small_batches

# production runs pass a key of their own
KEY = "slotstream"
# columns of the collision check, its rounds, and entities drawn again that are broadcast at most
AGAIN, PAGE, ROUNDS, BROADCAST = "_drawn_again", "_page", 20, 100_000

# fixed values: given names by script and sex
GIVEN = {
    ("latin", "m"): (
        "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew "
        "Anthony Steven Paul Andrew Peter Pierre Hans Carlos Miguel Antonio Stefan Lukas"
    ).split(),
    ("latin", "f"): (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa "
        "Margaret Sandra Ashley Emily Anna Marie Sophie Petra Carmen Lucia Julia Claudia"
    ).split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Андрей Михаил Николай Владимир".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
}
# fixed values: titles before a name
TITLES = "Mr Mrs Ms Miss Dr Prof Sir Madam Herr Frau Monsieur Madame Señor Señora".split()
# fixed values: endings of surnames that tell the sex
ENDINGS = "ская ский цкая цкий ова ева ина ов ев ин".split()
NAMES = {name: kind for kind, names in GIVEN.items() for name in names}

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
CAPITALISED = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё'-]+"
# an optional country code, and three groups
GROUPS = r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}"
PATTERNS = {
    "email": r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": (
        r"(?<![^\W_])(?i:password|passwd|pwd|token|secret|api[_-]?key)[ \t]*[=:][ \t]*[\"']?"
        r"(?P<value>[^\s\"']{6,})"
    ),
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": rf"(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<!\w)[2-6]\d{3}(?:\d{9,15}|(?:[ -]\d{4}){3}|[ -]\d{6}[ -]\d{5})(?!\w)",
    # the second is a run of groups of digits, of which is_phone tells how many are a number
    "phone": (
        r"(?=[+(\d])(?:(?<!\w)\+\d{9,15}(?!\w)"
        r"|(?<![\w.+])(?<!\d,)(?=(?:[ .+()-]{0,3}\d){9})(?:\+?\(\+?\d{1,5}\)[ .-]?\d{1,8}|\+?\d{1,8}(?=[ .(-]))"
        r"(?:(?:[ .-]|[ ]?\(\d{1,5}\)[ .-]?)\d{1,8}){0,8}(?!\w)"
        rf"|(?<![\w.+]){GROUPS}(?!\w))"
    ),
    "name": (
        rf"\b(?:(?:{'|'.join(TITLES)})\b\.?[ ](?P<titled>{CAPITALISED}(?:[ ]{CAPITALISED})?)"
        rf"|(?P<full>(?:{'|'.join(NAMES)})[ ]{CAPITALISED}))"
    ),
}
FINDER = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))
# in any case; one of these, a title or a given name must be in a text without digits or @
SECRETS = ["password", "passwd", "pwd", "token", "secret", "api"]


@dataclass(frozen=True)
class Keyed:
    key: str

    def draw(self, label: str, n: int) -> int:
        """A number below `n` that depends on key and label."""
        digest = blake2b(label.encode(), key=self.key.encode()[:64], digest_size=32).digest()
        return int.from_bytes(digest) % n

    def _walk(self, x: int, n: int, label: str, rounds: range) -> int:
        """A permutation of 0 to n - 1: a Feistel network over an even number of bits, repeated
        until the result lies in range. `rounds` backwards gives the inverse."""
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        forward = rounds.step > 0
        while True:
            left, right = x >> half, x & mask
            for turn in rounds:
                if forward:
                    left, right = right, left ^ self.draw(f"{label}|{turn}|{right}", mask + 1)
                else:
                    left, right = right ^ self.draw(f"{label}|{turn}|{left}", mask + 1), left
            x = left << half | right
            if x < n:
                return x

    def other(self, x: int, n: int, label: str) -> int:
        """A bijection of 0 to n - 1 that maps no number to itself, if there are two."""
        if n < 2:
            return x
        step = 1 + self.draw(f"{label}|step", n - 1)
        there = (self._walk(x, n, label, range(8)) + step) % n
        return self._walk(there, n, label, range(7, -1, -1))

    def spelled(self, text: str, alphabets: list[str], label: str) -> str:
        """`text` with every character replaced by one of its alphabet, all of them at once;
        characters of the empty alphabet stay."""
        value, n = 0, 1
        for char, letters in zip(text, alphabets, strict=True):
            if letters:
                value, n = value * len(letters) + letters.index(char), n * len(letters)
        form = "".join(x[0] if x else c for c, x in zip(text, alphabets, strict=True))
        value = self.other(value, n, f"{label}|{form}")
        out = []
        for char, letters in zip(reversed(text), reversed(alphabets), strict=True):
            if letters:
                value, place = divmod(value, len(letters))
                char = letters[place]
            out.append(char)
        return "".join(reversed(out))


DIGITS = "0123456789"
ALPHABETS = [
    DIGITS,
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "AEIOU",
    "BCDFGHJKLMNPQRSTVWXYZ",
    "аеиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "АЕИОУЭЮЯ",
    "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
]
ALPHABET_OF = {char: letters for letters in ALPHABETS for char in letters}


def kept_form(text: str) -> list[str]:
    return [ALPHABET_OF.get(c, "") for c in text]


def refilled(form: str, digits: str) -> str:
    """`form` with its digits replaced by `digits`, in order."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form)


def cased(form: str, text: str) -> str:
    """`text` with the letter case of `form`, character by character."""
    return "".join(t.upper() if f.isupper() else t for f, t in zip(form, text, strict=True))


def luhn(digits: str) -> int:
    """Sum of a card number's digits, every second one from the right doubled, modulo 10."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def email(keyed: Keyed, text: str) -> str:
    low = text.lower()
    if len(low) != len(text):
        low = text
    stem, dot, top = low.rpartition(".")
    return cased(text, keyed.spelled(stem, kept_form(stem), "email") + dot + top)


def is_card(text: str) -> bool:
    """Whether the check digit and the issuer are those of a payment card."""
    digits = "".join(c for c in text if c.isdigit())
    return luhn(digits) == 0 and (digits[0] != "2" or 2221 <= int(digits[:4]) <= 2720)


def card(keyed: Keyed, text: str) -> str:
    digits = "".join(c for c in text if c.isdigit())
    issuer = digits[: 4 if digits[0] == "2" else 1]
    body = digits[len(issuer) : -1]
    new = issuer + keyed.spelled(body, [DIGITS] * len(body), "card" + issuer)
    return refilled(text, new + str(-luhn(new + "0") % 10))


THREE_GROUPS = re.compile(GROUPS)
DATE = re.compile(r"(?<!\d)(?:\d{4}-\d\d-\d\d|\d\d?[.-]\d\d?[.-]\d{4})(?!\d)")
# country codes of one and two digits; the others have three
SHORT_CODES = {
    *("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44"),
    *("45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61"),
    *("62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95"),
    "98",
}
# digits after the country code, where all numbers have as many
LENGTHS = {"1": 10, "7": 10, "33": 9, "34": 9}


def phone_parts(text: str) -> tuple[str, str]:
    """Digits of the country code or trunk prefix, which stay, and those of the number."""
    digits = "".join(c for c in text if c.isdigit())
    at = 0 if "+" in text[:2] else 2 if digits[:2] == "00" else None
    if at is None:
        code = 1 if digits[0] == "0" else max(0, len(digits) - 10)
        return digits[:code], digits[code:]
    code = at + next((n for n in (1, 2) if digits[at : at + n] in SHORT_CODES), 3)
    code += digits[code : code + 1] == "0"
    return digits[:code], digits[code:]


def is_phone(text: str) -> bool:
    """Whether groups of digits are a phone number: an international one; one in parentheses or
    with a leading 0; three groups; or groups of two to four digits with one separator. Dates, and
    pairs of digits without a leading 0, are not."""
    groups = re.findall(r"\d+", text)
    whole = sum(map(len, groups))
    if not 9 <= whole - 2 * groups[0].startswith("00") <= 15 and not 9 <= whole <= 15:
        return False
    if THREE_GROUPS.fullmatch(text):
        return True
    if len(groups) > 8 or DATE.search(text):
        return False
    if "+" in text[:2]:
        return True
    if "(" in text:
        return text[0] == "(" or len(groups[0]) == 1
    separators = len(set(re.findall(r"[ .-]", text)))
    wide = max(map(len, groups)) > 2
    if groups[0][0] == "0":
        return len(groups[0]) > 1 and len(groups) > 1 and (wide or separators == 1)
    return (
        wide
        and separators == 1
        and 3 <= len(groups) <= 4
        and all(2 <= len(x) <= 4 for x in groups)
    )


def phone_length(run: str) -> int:
    """Characters of the phone number that `run` begins with; 0 if with none."""
    fits, digits = [], 0
    for group in re.finditer(r"\d+", run):
        digits += group.end() - group.start()
        if 9 <= digits <= 17 and is_phone(run[: group.end()]):
            fits.append(group.end())
    for end in fits:
        code, number = phone_parts(run[:end])
        if "+" in run[:2] and LENGTHS.get(code.rstrip("0")) == len(number):
            return end
    return max(fits, default=0)


def phone(keyed: Keyed, text: str) -> str:
    code, number = phone_parts(text)
    return refilled(text, code + keyed.spelled(number, [DIGITS] * len(number), "phone"))


def ssn(keyed: Keyed, text: str) -> str:
    digits = text.replace("-", "")
    return refilled(text, keyed.spelled(digits, [DIGITS] * 9, "ssn"))


def ip(keyed: Keyed, text: str) -> str:
    octets = text.split(".")
    ranges = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(x)] for x in octets]
    value, n = 0, 1
    for octet, (low, size) in zip(octets, ranges, strict=True):
        value, n = value * size + int(octet) - low, n * size
    value = keyed.other(value, n, "ip" + "".join(str(len(x)) for x in octets))
    out = []
    for low, size in reversed(ranges):
        value, place = divmod(value, size)
        out.append(str(low + place))
    return ".".join(reversed(out))


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def iban(keyed: Keyed, text: str) -> str:
    plain = text.replace(" ", "")
    body = keyed.spelled(plain[4:], [DIGITS if c.isdigit() else UPPER for c in plain[4:]], "iban")
    check = 98 - iban_rest(plain[:2] + "00" + body)
    made = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(made) for c in text)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = DIGITS + "abcdef"


def secret(keyed: Keyed, text: str) -> str:
    if all(c in HEX for c in text):
        return keyed.spelled(text, [HEX] * len(text), "hex")
    return keyed.spelled(text, kept_form(text), "secret")


def access_key(keyed: Keyed, text: str) -> str:
    return text[:4] + keyed.spelled(text[4:], [UPPER + DIGITS] * 16, "access")


def surname(keyed: Keyed, text: str) -> str:
    end = next((x for x in ENDINGS if text.endswith(x) and len(text) > len(x) + 1), "")
    stem = text[: len(text) - len(end)]
    made = keyed.spelled(stem.lower(), kept_form(stem.lower()), "surname" + end)
    return cased(stem, made) + end


def name(keyed: Keyed, text: str) -> str:
    first, blank, last = text.partition(" ")
    if first not in NAMES:
        return " ".join(surname(keyed, x) for x in text.split(" "))
    same = GIVEN[NAMES[first]]
    given = same[keyed.other(same.index(first), len(same), "given" + "".join(NAMES[first]))]
    return given + blank + (surname(keyed, last) if last else "")


MAKERS: dict[str, Callable[[Keyed, str], str]] = {
    "email": email,
    "secret": secret,
    "access_key": access_key,
    "iban": iban,
    "ip": ip,
    "ssn": ssn,
    "card": card,
    "phone": phone,
    "name": name,
}


# digits of other scripts than ASCII, by code point
FOREIGN = {
    c: str(digit)
    for c in range(128, sys.maxunicode + 1)
    if (digit := unicodedata.decimal(chr(c), -1)) >= 0
}
# two sets, as `re` looks code points beyond U+FFFF up one range after another
FOREIGN_DIGIT = re.compile(
    f"(?=[{chr(min(FOREIGN))}-{chr(max(FOREIGN))}])"
    f"(?:[{''.join(chr(c) for c in FOREIGN if c < 65536)}]"
    f"|[{''.join(chr(c) for c in FOREIGN if c >= 65536)}])"
)


def western(text: str) -> str:
    """`text` with ASCII digits for those of other scripts."""
    return text.translate(FOREIGN) if not text.isascii() and FOREIGN_DIGIT.search(text) else text


def same_entity(kind: str, text: str, form: str | None = None) -> str:
    """What all spellings of one entity have in common; `form` is another of the same format,
    whose country code or trunk prefix is as long."""
    text = western(text)
    if kind == "email":
        return text.lower()
    if kind == "phone":
        return "".join(c for c in text if c.isdigit())[len(phone_parts(western(form or text))[0]) :]
    if kind in ("card", "ssn", "iban"):
        return text.replace(" ", "").replace("-", "")
    return text


@lru_cache(maxsize=100_000)
def surrogate(key: str, kind: str, text: str) -> str:
    plain = western(text)
    made = MAKERS[kind](Keyed(key), plain)
    if plain == text:
        return made
    # each digit in the script of the one it stands for
    return "".join(
        chr(ord(old) - int(FOREIGN[ord(old)]) + int(new))
        if ord(old) in FOREIGN and new in DIGITS
        else new
        for old, new in zip(text, made, strict=True)
    )


def entities(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of every entity, in order."""
    text, at = western(text), 0
    while found := FINDER.search(text, at):
        at = found.end()
        kind = next(k for k in PATTERNS if found.group(k) is not None)
        start, end = found.span(kind)
        if kind == "secret":
            start, end = found.span("value")
        elif kind == "name":
            start, end = found.span("titled" if found.group("titled") else "full")
        elif kind == "iban" and iban_rest(found.group().replace(" ", "")) != 1:
            continue
        elif kind == "card" and not is_card(found.group()):
            continue
        elif kind == "phone":
            length = phone_length(found.group())
            if not length:
                # a number may begin at a later group
                at = start + 1
                continue
            at = end = start + length
        yield kind, start, end


# how often each entity that must not keep its first surrogate is drawn again
Again = dict[tuple[str, str], int]
# makes the surrogate of a text from key, kind and text
Maker = Callable[[str, str, str], str]


def drawn(key: str, kind: str, text: str, again: Again, make: Maker = surrogate) -> str:
    """The surrogate, or that of a later round of keys."""
    turn = again.get((kind, same_entity(kind, text)), 0) if again else 0
    return make(f"{key}\0{turn}" if turn else key, kind, text)


def replaced(
    text: str, key: str, again: Again | None = None, make: Maker = surrogate
) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and the entities of the original."""
    out, at, found = [], 0, list(entities(text))
    for kind, start, end in found:
        out += [text[at:start], drawn(key, kind, text[start:end], again or {}, make)]
        at = end
    return "".join([*out, text[at:]]), found


@lru_cache(maxsize=1)
def screen() -> str:
    """A pattern for Arrow. Every entity holds a digit, @, an access key's mark, one of SECRETS,
    a title or a given name, in whatever surroundings: what FINDER wants around them is left to
    FINDER. Case is that of `re`, where s is also U+017F and k the Kelvin sign."""
    letters = "".join(sorted(set("".join(SECRETS))))
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    forms = "".join(re.findall(f"(?i:[{letters}])", every))
    folded = {c: "".join(re.findall(f"(?i:{c})", forms)) for c in letters}
    return "|".join(
        [
            f"[0-9@{''.join(map(chr, FOREIGN))}]",
            *("AKIA", "ASIA"),
            *("".join(f"[{folded[c]}]" for c in word) for word in SECRETS),
            *(f"{x}[ .]" for x in TITLES),
            *(f"{x} " for x in NAMES),
        ]
    )


def suspects(part: pa.RecordBatch) -> np.ndarray:
    """Rows that may hold an entity."""
    hit = pc.match_substring_regex(part.column("text").cast(pa.large_string()), screen())
    return np.flatnonzero(hit.fill_null(False).to_numpy(zero_copy_only=False))


SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start_char", pa.int64()), ("end_char", pa.int64())])
)


def again_of(part: pa.RecordBatch, row: int) -> Again:
    told = part.column(AGAIN)[row].as_py() if AGAIN in part.schema.names else None
    return {(x["kind"], x["entity"]): x["turn"] for x in told or []}


def cleaned(
    part: pa.RecordBatch, key: str, make: Maker = surrogate
) -> tuple[pa.Array, list[list]]:
    """The text column with surrogates, and each row's entities."""
    spans: list[list] = [[] for _ in range(part.num_rows)]
    column = part.column("text").cast(pa.string())
    changed, texts = np.zeros(part.num_rows, bool), []
    for row in suspects(part).tolist():
        text, found = replaced(column[row].as_py(), key, again_of(part, row), make)
        if found:
            spans[row] = found
            changed[row] = True
            texts.append(text)
    if texts:
        column = pc.replace_with_mask(column, pa.array(changed), pa.array(texts, pa.string()))
    return column, spans


def anonymise(docs: DataFrame, *, key: str = KEY, make: Maker = surrogate) -> DataFrame:
    """`doc_id`, `text` with surrogates, `n_entities`, and `spans` in the original text.

    Surrogates are checked for collisions over all of `docs` first (`distinct_surrogates`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, spans = cleaned(part, key, make)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        text,
                        pa.array([len(x) for x in spans], pa.int64()),
                        pa.array(
                            [
                                [
                                    {"kind": k, "start_char": a, "end_char": b}
                                    for k, a, b in found
                                ]
                                for found in spans
                            ],
                            SPANS,
                        ),
                    ],
                    names=["doc_id", "text", "n_entities", "spans"],
                )

    checked = distinct_surrogates(docs.select("doc_id", "text"), key, make)
    return checked.transform(small_batches).mapInArrow(
        run,
        "doc_id long, text string, n_entities long, "
        "spans array<struct<kind:string,start_char:long,end_char:long>>",
    )


def rewrite(docs: DataFrame, *, key: str = KEY, make: Maker = surrogate) -> DataFrame:
    """`docs` with surrogates in `text`, and `n_chars` as it is then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, _ = cleaned(part, key, make)
                yield part.set_column(part.schema.get_field_index("text"), "text", text).select(names)

    names = docs.columns
    checked = distinct_surrogates(docs, key, make)
    out = checked.transform(small_batches).mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_chars").isNotNull(), F.length("text"))
        out = out.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return out


def pairs(docs: DataFrame, key: str, make: Maker = surrogate) -> DataFrame:
    """Distinct `kind`, `entity`, `made` and `turn` of all entities, with the digest (`page`) of each
    text that holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                column, pages = part.column("text"), part.column(PAGE)
                found = set()
                for row in suspects(part).tolist():
                    text, again = column[row].as_py(), again_of(part, row)
                    for kind, a, b in entities(text):
                        value = text[a:b]
                        entity = same_entity(kind, value)
                        made = same_entity(kind, drawn(key, kind, value, again, make), value)
                        turn = again.get((kind, entity), 0)
                        found.add((kind, entity, made, turn, pages[row].as_py()))
                rows = sorted(found)
                types = [pa.string()] * 3 + [pa.int32(), pa.int64()]
                names = ["kind", "entity", "made", "turn", PAGE]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], names=names
                )

    told = [x for x in (AGAIN,) if x in docs.columns]
    found = docs.select("text", F.xxhash64("text").alias(PAGE), *told).transform(small_batches)
    schema = f"kind string, entity string, made string, turn int, {PAGE} long"
    return found.mapInArrow(run, schema)


def shared_surrogates(found: DataFrame) -> DataFrame:
    """`kind`, `entity`, `turn` of entities whose surrogate one of smaller text has as well."""
    each = found.select("kind", "made", "entity", "turn").distinct()
    owners = each.groupBy("kind", "made").agg(
        F.min("entity").alias("owner"), F.count_distinct("entity").alias("n")
    )
    owners = owners.filter("n > 1").select("kind", "made", "owner")
    return each.join(owners, ["kind", "made"]).filter("entity <> owner").select("kind", "entity", "turn").distinct()


def distinct_surrogates(docs: DataFrame, key: str, make: Maker = surrogate) -> DataFrame:
    """`docs`, with a column AGAIN if some entities are drawn again.

    Surrogates of one format differ by construction; those of different formats may meet. All
    entities' surrogates are compared; of those that share one all but the smallest are drawn with
    another round of keys, until none meet. What is drawn again goes to the documents that hold
    it by a digest of their text. After ROUNDS rounds a ValueError says that a format is too narrow.
    """
    again = None
    for _ in range(ROUNDS):
        now = docs if again is None else with_again(docs, again)
        found = materialise(pairs(now, key, make))
        faulty = shared_surrogates(found)
        if faulty.isEmpty():
            return now
        new = faulty.select("kind", "entity", (F.col("turn") + 1).alias("turn"))
        told = found.select("kind", "entity", PAGE).distinct().join(new, ["kind", "entity"])
        # an entity drawn twice has its last turn only
        every = told if again is None else again.unionByName(told)
        again = materialise(every.groupBy("kind", "entity", PAGE).agg(F.max("turn").alias("turn")))
    raise ValueError(f"surrogates still meet after {ROUNDS} rounds of keys")


def with_again(docs: DataFrame, again: DataFrame) -> DataFrame:
    """`docs` with the entities of each text that are drawn again; few, so they are broadcast up to
    BROADCAST entities, and joined beyond that."""
    lists = again.groupBy(PAGE).agg(F.collect_list(F.struct("kind", "entity", "turn")).alias(AGAIN))
    if again.limit(BROADCAST + 1).count() <= BROADCAST:
        lists = F.broadcast(lists)
    return docs.join(lists, F.xxhash64("text") == F.col(PAGE), "left").drop(PAGE)


def collisions(docs: DataFrame, *, key: str = KEY, make: Maker = surrogate) -> DataFrame:
    """Kind and number of surrogates that stand for several entities before any is drawn again
    (`shared`), and of entities with several surrogates (`split`); no rows if there are none."""
    each = pairs(docs, key, make).select("kind", "entity", "made").distinct()
    shared = each.groupBy("kind", "made").count().filter("count > 1").groupBy("kind").count()
    split = each.groupBy("kind", "entity").count().filter("count > 1").groupBy("kind").count()
    return shared.select("kind", F.lit("shared").alias("fault"), "count").unionByName(
        split.select("kind", F.lit("split").alias("fault"), "count")
    )


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anonymise(read(spark, sf_dir, "documents"))
