"""Personal data replaced by keyed surrogates.

Every detected value (e-mail address, telephone, IPv4 address, card, social
security number, IBAN, secret, name of a person) is replaced by another of
its type, script, gender and format. A surrogate is a keyed permutation of
the values of its format, so

* equal values get equal surrogates in all documents (coreference), and
* different values of a format get different ones (distinctness),

without a table of all values. A check over the distinct values of the
corpus finds surrogates that equal a real value of the corpus or each other
(possible only where formats overlap); these values get the next surrogate
of their own sequence until the check is clean, and only they are kept in a
table.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Store, fresh, small_batches

KEY = "surrogates-1"
# Rows of the table of exceptions that go to every task; beyond, it is joined.
EXCEPTION_ROWS = 100_000

# Name lists by gender and script; a surrogate comes from the list of the original.
GIVEN = {
    "f latin": "Alice Amelia Anna Barbara Carla Caroline Charlotte Clara Claire Elena Elisabeth Emily Emma Eva Frieda "
               "Hannah Helen Ingrid Isabel Jane Julia Karin Laura Linda Lucia Margaret Maria Marie Martha Mary "
               "Monika Nicole Patricia Paula Rosa Sabine Sarah Sofia Sophie Susan Teresa Ursula",
    "m latin": "Albert Alexander Andreas Anthony Antonio Bernard Carlos Charles Christian Daniel David Diego Edward "
               "Felix Fernando Francis Frank George Hans Henry Jacques James Javier Jean John Joseph Juan Karl Klaus "
               "Louis Luis Manuel Mark Michael Michel Miguel Otto Paul Peter Philip Pierre Richard Robert Stefan "
               "Thomas Walter William",
    "f cyrillic": "Анна Вера Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия",
    "m cyrillic": "Александр Андрей Борис Виктор Дмитрий Иван Михаил Николай Павел Сергей",
    "f greek": "Άννα Ελένη Ιωάννα Κατερίνα Μαρία Σοφία",
    "m greek": "Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Πέτρος",
}
SURNAMES = {
    "latin": "Baker Becker Bernard Braun Brown Carter Castro Clark Cooper Davies Delgado Dubois Durand Evans Fischer "
             "Fontaine Garcia Gomez Green Hoffmann Hughes Johnson Jones Keller Lambert Lefebvre Lopez Martin Martinez "
             "Meyer Miller Moreau Moreno Morgan Navarro Parker Petit Ramos Richter Roberts Romero Roux Schmidt "
             "Schneider Smith Taylor Turner Vargas Vogel Wagner Walker Weber White Williams Wright Zimmermann",
    "cyrillic": "Волков Иванов Козлов Лебедев Морозов Новиков Павлов Петров Смирнов Соколов",
    "greek": "Αλεξίου Βασιλείου Γεωργίου Δημητρίου Νικολάου Παπαδόπουλος",
}
TITLES = {
    "m": "Mr Herr Señor Sr Monsieur",
    "f": "Mrs Ms Miss Frau Señora Sra Madame Mme",
    "": "Dr Prof",
}

_GIVEN = {name: kind for kind, names in GIVEN.items() for name in names.split()}
_SURNAME = {name: kind for kind, names in SURNAMES.items() for name in names.split()}
_TITLE = {t: g for g, names in TITLES.items() for t in names.split()}

_CAP = "[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫА-ЯЁ]"
_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
                    r"(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
_SECRET = re.compile(r"(?i)\b(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|auth)\b[\"']?\s{0,3}[=:]\s{0,3}"
                     r"[\"']?(?P<v>[A-Za-z0-9+/_.-]{8,}={0,2})")
_CLOUD_KEY = re.compile(r"\b(?:AKIA|ASIA)(?P<v>[0-9A-Z]{16})\b")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_DIGITS = re.compile(r"[+(]?\d[\d .()/-]{5,}\d")
_NUMBER = re.compile(
    r"(?P<phone>(?:\+?1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<!\d)(?:\+?1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?!\d|[.-]\d)"
    r"|\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\d))"
    r"|(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?!\d|-\d))"
    r"|(?P<card>(?<![\d.-])(?:\d{4}[ -]){3}\d{1,7}(?!\d|-\d)|(?<!\d)\d{13,19}(?!\d))"
)
_NAME_START = re.compile(rf"\b({_CAP}[\w'’-]*)(\.?) (?={_CAP})")
# Before a number whose check digit fails, or in its writing, this tells a card.
_CARD_WORD = re.compile(r"(?i)\b(?:(?:credit|debit|bank|master|kredit|giro)?(?:card|karte|carte|tarjeta)s?"
                        r"|kartennummer|visa|amex|карт[аыуе])\b")
_CARD_GROUPS = re.compile(r"[3-6]\d{3}([ -])\d{4}\1\d{4}\1\d{4}")
_CARD_REACH = 32
# Up to three words; initials between them belong to the name and stay.
_NAME = re.compile(rf"{_CAP}[\w'’-]*[\w](?:(?: {_CAP}\.){{0,2}} {_CAP}[\w'’-]*[\w]){{0,2}}")
_HEAD = re.compile(r"\w+")
_POSSESSIVE = ("'s", "’s")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def script_of(word: str) -> str:
    c = word[0]
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def _number(kind: str, raw: str, before: str = "") -> str | None:
    """Canonical value of a number-like match, or None if it is none of its type."""
    digits = re.sub(r"\D", "", raw)
    if kind == "phone":
        if not 7 <= len(digits) <= 15:
            return None
        return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
    if kind == "ip":
        parts = raw.split(".")
        return raw if all(int(p) <= 255 and str(int(p)) == p for p in parts) else None
    if kind == "card":
        if not 13 <= len(digits) <= 19:
            return None
        if luhn(digits) or _CARD_GROUPS.fullmatch(raw):
            return digits
        return digits if len(digits) == 16 and digits[0] in "3456" and _CARD_WORD.search(before) else None
    return digits


def _mentions(text: str, persons: dict[str, tuple[str, str]]) -> Iterator[tuple[int, str]]:
    """(place, word) of the words of names wherever they stand whole in a text: one pass."""
    heads: dict[str, list[str]] = {}
    for w in persons:
        heads.setdefault(_HEAD.match(w)[0], []).append(w)
    for m in _HEAD.finditer(text):
        for w in heads.get(m[0], ()):
            end = m.start() + len(w)
            if text.startswith(w, m.start()) and not _HEAD.match(text, end):
                yield m.start(), w


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical value) of the values in a text, in order, not overlapping."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        found += [(m.start("v"), m.end("v"), "secret", m["v"]) for m in _SECRET.finditer(text)
                  if any(map(str.isdigit, m["v"]))]
    if "AKIA" in text or "ASIA" in text:
        found += [(m.start("v"), m.end("v"), "secret", m["v"]) for m in _CLOUD_KEY.finditer(text)]
    numbers = list(_DIGITS.finditer(text))
    if numbers:
        for m in _IBAN.finditer(text):
            value = m[0].replace(" ", "")
            if 15 <= len(value) <= 34 and iban_valid(value):
                found.append((m.start(), m.end(), "iban", value))
        for run in numbers:
            # one place more on both sides, for what must not stand there
            lo, hi = max(0, run.start() - 2), min(len(text), run.end() + 2)
            part = text[lo:hi]
            for m in _NUMBER.finditer(part):
                at = lo + m.start()
                canon = _number(m.lastgroup, m[0], text[max(0, at - _CARD_REACH): at])
                if canon is not None:
                    found.append((at, lo + m.end(), m.lastgroup, canon))
    end, persons = 0, {}  # words of names found: (type, canonical value)
    for m in _NAME_START.finditer(text):
        if m.start() < end:
            continue
        word, dot = m[1], m[2]
        if word in _TITLE:
            names, gender = _NAME.match(text, m.end()), _TITLE[word]
        elif word in _GIVEN and not dot:
            names, gender = _NAME.match(text, m.start()), _GIVEN[word][0]
        else:
            continue
        if names:
            end = names.end()
            words = [(names.start() + w.start(), w[0][:-2] if w[0].endswith(_POSSESSIVE) else w[0])
                     for w in re.finditer("[^ ]+", names[0]) if w[0][-1] != "."]
            if words[0][1] in _GIVEN:
                gender = _GIVEN[words[0][1]][0]
            for i, (at, w) in enumerate(words):
                # a listed given name is one wherever it stands, unless it ends the name and is a listed surname too
                given = w in _GIVEN and (i < len(words) - 1 or w not in _SURNAME)
                kind = f"given {_GIVEN[w]}" if given else f"surname {script_of(w)}"
                canon = w
                if not given and kind == "surname cyrillic" and w.endswith("ова") and gender == "f":
                    canon = w[:-1]  # the ending stays and keeps the gender
                found.append((at, at + len(canon), kind, canon))
                persons.setdefault(w, (kind, canon))
    if persons:
        taken = {f[0] for f in found}
        found += [(at, at + len(persons[w][1]), *persons[w]) for at, w in _mentions(text, persons) if at not in taken]
    found.sort(key=lambda f: (f[0], -f[1]))
    out, end = [], 0
    for f in found:
        if f[0] >= end:
            out.append(f)
            end = f[1]
    return out


_ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
              "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
              "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "àáâäçèéêëìíîïñòóôöùúûü", "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"]
_KIND = {c: a for a in _ALPHABETS for c in a}
_HEX = dict.fromkeys("0123456789abcdef", "0123456789abcdef")
_CHUNK = 96  # characters permuted together


class Surrogates:
    """Keyed permutations of the values of each type."""

    def __init__(self, key: str):
        self.key = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        h = hashlib.blake2b(tweak + bytes([i]) + half.to_bytes(size, "big"), key=self.key, digest_size=min(64, size))
        return int.from_bytes(h.digest(), "big") & ((1 << bits) - 1)

    def permute(self, n: int, x: int, tweak: str) -> int:
        """A permutation of 0 .. n - 1: a Feistel network, walked until it is below n."""
        if n < 2:
            return x
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        low, t = (1 << bits) - 1, tweak.encode() + b"\0"
        while True:
            left, right = x >> bits, x & low
            for i in range(8):
                left, right = right, left ^ self._round(t, i, right, bits)
            x = left << bits | right
            if x < n:
                return x

    def format(self, value: str, tweak: str, kinds: dict[str, str] = _KIND) -> str:
        """Permutes the values of one format: every letter or digit stays of
        its alphabet, everything else stays. Long values go in parts, each
        under the ones before it."""
        out = ""
        for at in range(0, len(value), _CHUNK):
            part = value[at: at + _CHUNK]
            shape = "".join(kinds.get(c, c)[0] for c in part)
            n, x = 1, 0
            for c in part:
                if c in kinds:
                    n, x = n * len(kinds[c]), x * len(kinds[c]) + kinds[c].index(c)
            x = self.permute(n, x, f"{tweak}\0{shape}\0{value[:at]}")
            new = []
            for c in reversed(part):
                if c in kinds:
                    x, r = divmod(x, len(kinds[c]))
                    c = kinds[c][r]
                new.append(c)
            out += "".join(reversed(new))
        return out

    @functools.lru_cache(maxsize=64)
    def _next(self, kind: str, names: str, attempt: int) -> dict[str, str]:
        """Every name of a list to one after it in a keyed order, with each attempt one further."""
        order = sorted(names.split(), key=lambda w: hashlib.blake2b(f"{kind} {w}".encode(), key=self.key).digest())
        by = 1 + attempt % (len(order) - 1)
        return {w: order[(i + by) % len(order)] for i, w in enumerate(order)}

    def walk(self, value: str, tweak: str, step, same) -> str:
        """Steps of a permutation until ``same`` holds as it does for ``value``: again a permutation."""
        want, x = same(value), step(value, tweak)
        while same(x) != want:
            x = step(x, tweak)
        return x

    def of(self, kind: str, canon: str, attempt: int = 0) -> str:
        """The surrogate of a canonical value; ``attempt`` numbers its sequence."""
        tweak = f"{kind} {attempt}"
        if kind.startswith("given "):
            return self._next(kind, GIVEN[kind[6:]], attempt)[canon]
        if kind.startswith("surname "):
            if canon in _SURNAME:
                return self._next(f"surname {_SURNAME[canon]}", SURNAMES[_SURNAME[canon]], attempt)[canon]
            if canon in _GIVEN:
                return self.of(f"given {_GIVEN[canon]}", canon, attempt)
            # in no list, and so are nearly all values of a format: the walk is short
            return self.walk(canon, tweak, self.format, lambda w: w in _SURNAME or w in _GIVEN)
        if kind == "email":
            local, _, domain = canon.partition("@")
            host, _, top = domain.rpartition(".")
            return f"{self.format(local, tweak + domain)}@{self.format(host, f'host {attempt}')}.{top}"
        if kind == "ip":
            def step(v, t):
                return str(ipaddress.IPv4Address(self.permute(1 << 32, int(ipaddress.IPv4Address(v)), t)))

            return self.walk(canon, tweak, step, lambda v: ipaddress.IPv4Address(v).is_global)
        if kind == "phone":
            keep = max(0, len(canon) - 10)
            head = canon[:keep]

            def regular(v):
                return len(v) == 10 and v[0] > "1" and v[3] > "1"

            return head + self.walk(canon[keep:], f"{tweak} {head}", self.format, regular)
        if kind == "card":
            first = canon[0]
            return first + self.walk(canon[1:], f"{tweak} {first}", self.format, lambda v: luhn(first + v))
        if kind == "ssn":
            def issued(v):
                return v[:3] not in ("000", "666") and v[0] != "9" and v[3:5] != "00" and v[5:] != "0000"

            return self.walk(canon, tweak, self.format, issued)
        if kind == "iban":
            new = self.format(canon[4:], f"{tweak} {canon[:2]}")
            check = 98 - int("".join(str(int(c, 36)) for c in new + canon[:2] + "00")) % 97
            return f"{canon[:2]}{check:02d}{new}"
        return self.format(canon, tweak, _HEX if set(canon) <= _HEX.keys() else _KIND)

    def write(self, kind: str, raw: str, canon: str, attempt: int) -> str:
        """The surrogate in the writing of ``raw``."""
        new = self.of(kind, canon, attempt)
        if kind == "email":
            head, _, _ = raw.partition("@")
            at = len(head)
            cased = "".join(n.upper() if i < len(raw) and raw[i].isupper() else n for i, n in enumerate(new))
            return cased if len(new) == len(raw) and new[at] == "@" else new
        if kind in ("phone", "card", "ssn", "iban"):
            chars = [i for i, c in enumerate(raw) if c.isalnum()]
            out = list(raw)
            for i, c in zip(reversed(chars), reversed(new)):
                out[i] = c
            return "".join(out)
        return new


@functools.lru_cache(maxsize=4)
def _surrogates(key: str) -> Surrogates:
    return Surrogates(key)


def replace(text: str, key: str, exceptions: dict[tuple[str, str], int]) -> tuple[str, list[str]]:
    """(text with surrogates, types replaced)."""
    found = detect(text)
    if not found:
        return text, []
    s, out, at = _surrogates(key), [], 0
    for start, end, kind, canon in found:
        out += [text[at:start], s.write(kind, text[start:end], canon, exceptions.get((kind, canon), 0))]
        at = end
    out.append(text[at:])
    return "".join(out), [f[2] for f in found]


def _listed(kind: str) -> bool:
    """Names are permuted within lists, so a surrogate may be another's real name."""
    return kind.startswith(("given ", "surname "))


def values(texts: DataFrame, numbered: str | None = None) -> DataFrame:
    """(type, value) found in column t, once a batch; with a ``numbered``
    column, once a row and with that number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in small_batches(whole):
                ids = b.column(numbered).to_pylist() if numbered else [0] * b.num_rows
                got = sorted({(i, k, v) for i, t in zip(ids, b.column("t").to_pylist()) if t
                              for _, _, k, v in detect(t)})
                cols = [pa.array([g[j] for g in got], kind)
                        for j, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, ["n", "type", "value"])

    return texts.mapInArrow(run, "n bigint, type string, value string")


def _with_surrogate(found: DataFrame, key: str, attempt: int) -> DataFrame:
    @F.pandas_udf("string")
    def surrogate(kind: pd.Series, value: pd.Series) -> pd.Series:
        s = _surrogates(key)
        return pd.Series([s.of(k, v, attempt) for k, v in zip(kind, value)], dtype=object)

    return found.withColumn("surrogate", surrogate("type", "value"))


def exceptions_of(store: Store, texts: DataFrame, key: str) -> DataFrame:
    """(type, value, attempt) of the values whose first surrogate is a real
    value of the corpus or another value's surrogate."""
    found = store.put(values(texts).select("type", "value").distinct())
    listed = F.col("type").startswith("given ") | F.col("type").startswith("surname ")
    given = store.put(_with_surrogate(found, key, 0))
    attempt, settled, todo = 0, [], given
    taken = None  # surrogates that stand
    while True:
        real = found.select("type", F.col("value").alias("surrogate"))
        clash = todo.where(~listed).join(real, ["type", "surrogate"], "left_semi")
        if taken is not None:
            clash = clash.unionByName(todo.join(taken, ["type", "surrogate"], "left_semi"))
        twice = todo.groupBy("type", "surrogate").agg(F.count(F.lit(1)).alias("k"), F.min("value").alias("first"))
        second = todo.join(twice.where("k > 1"), ["type", "surrogate"]).where("value <> first").select(*todo.columns)
        bad = store.put(clash.unionByName(second).select("type", "value").distinct())
        good = todo.join(bad, ["type", "value"], "left_anti")
        if attempt:
            settled.append(good.select("type", "value", F.lit(attempt).alias("attempt")))
        if bad.isEmpty():
            break
        stands = good.select("type", "surrogate")
        taken = store.put(stands if taken is None else taken.unionByName(stands))
        attempt += 1
        todo = store.put(_with_surrogate(bad, key, attempt))
    if not settled:
        return store.spark.createDataFrame([], "type string, value string, attempt int")
    return store.put(functools.reduce(DataFrame.unionByName, settled))


def surrogates(docs: DataFrame, text_col: str = "text", key: str = KEY, found_col: str | None = None,
               exception_rows: int = EXCEPTION_ROWS) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced.

    All rows and all other columns stay as they are, whatever their names; a
    text without findings stays byte for byte, a null text null. With
    ``found_col`` the types replaced (array of strings, in order; empty if
    none) are returned in that column. The same value gets the same
    surrogate in every row (repeated rows stay equal), different values
    different ones; the key alone decides, so reruns and other tables agree
    but for the values that the collision check moves on.

    Names of persons: a title (``TITLES``) or a listed given name (``GIVEN``,
    about 120 in three scripts) must stand before a capitalised word; all
    words of a name so found are replaced in the whole text, alone as well.
    Names that no text introduces that way are not found and stay.
    """
    store = Store(docs.sparkSession, "pii")
    texts = docs.select(F.col(text_col).cast("string").alias("t"))
    moved = exceptions_of(store, texts, key)
    names = fresh(docs.columns, "_found")
    if moved.count() <= exception_rows:
        table = {(r["type"], r["value"]): r["attempt"] for r in moved.collect()}

        @F.pandas_udf("text string, found array<string>")
        def rewrite(text: pd.Series) -> pd.DataFrame:
            return pd.DataFrame(
                [(None, []) if t is None else replace(t, key, table) for t in text], columns=["text", "found"]
            )

        out = docs.withColumn(names, rewrite.asNondeterministic()(F.col(text_col).cast("string")))
    else:
        # number the rows, look their own values up by a join, and hand each row what it needs
        n, own = fresh(docs.columns, "_n"), fresh(docs.columns, "_own")
        rows = store.put(docs.withColumn(n, F.monotonically_increasing_id()))
        held = (
            values(rows.select(F.col(n).alias("n"), F.col(text_col).cast("string").alias("t")), "n")
            .join(moved, ["type", "value"])
            .groupBy("n").agg(F.collect_list(F.struct("type", "value", "attempt")).alias(own))
            .withColumnRenamed("n", "_row")
        )

        @F.pandas_udf("text string, found array<string>")
        def rewrite_own(text: pd.Series, held: pd.Series) -> pd.DataFrame:
            return pd.DataFrame(
                [(None, []) if t is None else
                 replace(t, key, {(h["type"], h["value"]): h["attempt"] for h in (hs if hs is not None else [])})
                 for t, hs in zip(text, held)], columns=["text", "found"],
            )

        joined = rows.join(held, rows[n] == held["_row"], "left")
        out = joined.withColumn(names, rewrite_own.asNondeterministic()(F.col(text_col).cast("string"), F.col(own)))
    cols = [F.col(f"{names}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if found_col:
        cols.append(F.col(f"{names}.found").alias(found_col))
    return out.select(*cols)
