"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Every entity has a canonical form, and its surrogate depends on the secret key and
that form alone, so all mentions of an entity, in any document and notation, get
the same surrogate. Numbers and addresses pass through a keyed permutation of the
strings of their format; names are drawn or built from the parts of their script.
Surrogates are then checked against each other over all documents: where two
entities would share one, or an entity would keep its own form, all but one draw
again. Only those second draws are sent to the tasks that rewrite the texts.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm.common import arrow_columns
from newsmill.session import materialize

#: Entities that drew again, which are sent to all tasks; beyond it the run fails.
MAX_REDRAWN = 1_000_000
MAX_DRAWS = 30
ROUNDS = 8

# Given names by script and gender, titles by gender, name parts by script.
GIVEN = {
    ("latin", "f"): "Anna Maria Elena Laura Sophie Julia Emma Clara Alice Marta Ines Carmen Lucia Paula Helga Greta Ingrid "
    "Monika Claire Camille Juliette Nathalie Sarah Emily Mary Susan Linda Karen Nancy Rachel".split(),
    ("latin", "m"): "John Peter Paul Thomas Michael David James Robert William Charles Hans Klaus Jürgen Stefan Dieter Pierre "
    "Jacques Antoine Michel Luc Carlos Miguel Javier Diego Luis Pedro Marco George Henry Frank".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Юлия Екатерина".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил Владимир Павел".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Σοφία Άννα Γεωργία Δήμητρα Ιωάννα".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Νίκος Κώστας Γιάννης Παναγιώτης Βασίλης Χρήστος".split(),
}
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Señora Sra Señorita Госпожа Κυρία".split(),
    "m": "Mr Herr Monsieur Señor Sr Господин Κύριος".split(),
    "": "Dr Prof Professor".split(),
}
PARTS = {
    "latin": ("ba ber bran cal cor dal del dor el fal fen gar hal hol jan kel lan lor mal mer nor ol per ran ros sal sel "
              "tan tor val vin wal wen zan").split(),
    "cyrillic": "ба бел вал вер гор дан дор ель зар кал кор лав лен мар мир нов ор пав рад сав сол тар тих фед хол чер".split(),
    "greek": "αλ βα γαρ δεν ελ ζα θεο καλ κορ λαμ μαν μελ νικ ξεν παν πετ ραλ σαβ στα ταλ φιλ χαρ".split(),
}
ENDINGS = {
    ("latin", "f"): ["a", "ina", "elle"], ("latin", "m"): ["o", "ert", "an"], ("latin", ""): ["er", "son", "mann", "ez", "et"],
    ("cyrillic", "f"): ["а", "ина"], ("cyrillic", "m"): ["ов", "ин"], ("cyrillic", ""): ["енко", "ук", "ский"],
    ("greek", "f"): ["α", "η"], ("greek", "m"): ["ος", "ης"], ("greek", ""): ["ίδης", "άκης", "όπουλος"],
}
#: Mail domains that tell nothing about a person and stay as they are.
OPEN_DOMAINS = "example.com example.net example.org gmail.com outlook.com hotmail.com yahoo.com icloud.com gmx.de web.de".split()
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß",
    "абвгдежзийклмнопрстуфхцчшщъыьэюяё",
    "αβγδεζηθικλμνξοπρστυφχψωάέήίόύώς",
)
# End of fixed values.

_CLASS = {ch: i for i, letters in enumerate(ALPHABETS) for ch in letters}


class Entity(NamedTuple):
    """A mention: its place, kind and canonical form; ``kind`` tells what must agree."""

    start: int
    end: int
    kind: str
    form: str


def script_of(word: str) -> str:
    first = word[0].lower()
    if first in ALPHABETS[3]:
        return "cyrillic"
    return "greek" if first in ALPHABETS[4] else "latin"


# --- finding ------------------------------------------------------------------

_LOCAL = re.compile(r"[\w.+%'\-]{1,64}\Z")
_DOMAIN = re.compile(r"[^\W_](?:[\w\-]{0,62})(?:\.[^\W_][\w\-]{0,62})+")
_NUMBER = re.compile(
    r"(?<![\w.@\-+])(?:"
    r"(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)"
    r"|(?P<ip>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})"
    r"|(?P<phone>\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d(?:[ .\-]?\d){4,12}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})"
    r"|(?P<card>\d(?:[ \-]?\d){12,18})"
    r")(?![\w]|[.\-]\d)"
)
_CLUSTER = re.compile(r"[0-9][0-9A-Z .\-()]{5,}")
_LEAD = "+(ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΩЁА-Я][^\W\d_]+")
_WORD = r"[^\W\d_][^\W\d_'’\-]*(?:[-'’][^\W\d_]+)*"
_TITLED = re.compile(rf"(?P<title>[^\W\d_]+)\.? (?P<rest>{_WORD}(?: {_WORD}){{0,2}})")
_NAMED = re.compile(rf"(?P<given>[^\W\d_]+)(?P<rest>(?: {_WORD}){{1,2}})")
_KNOWN = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
_KNOWN_UPPER = {name.upper(): name for name in _KNOWN}
_TITLE_GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}


def _luhn(digits: str) -> int:
    """The digit that makes the sum of ``digits`` and it valid."""
    doubled = (sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return -sum(doubled) % 10


def _iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(ch, 36)) for ch in f"{rest}{country}00"))
    return f"{98 - number % 97:02d}"


def _lower(ch: str) -> str:
    return low if len(low := ch.lower()) == 1 else ch


def _upper(ch: str) -> str:
    return high if len(high := ch.upper()) == 1 else ch


def _emails(text: str) -> Iterator[Entity]:
    at = text.find("@")
    while at >= 0:
        local = _LOCAL.search(text[max(0, at - 64) : at])
        domain = _DOMAIN.match(text, at + 1)
        if local and domain:
            start = at - len(local[0].lstrip(".'-+%"))
            if start < at:
                yield Entity(start, domain.end(), "email", "".join(map(_lower, text[start : domain.end()])))
        at = text.find("@", at + 1)


def _number_matches(text: str) -> Iterator[re.Match]:
    """Matches of the number pattern, tried only where digits are."""
    done = 0
    for cluster in _CLUSTER.finditer(text):
        start = cluster.start()
        while start > max(done, cluster.start() - 4) and text[start - 1] in _LEAD:
            start -= 1
        for m in _NUMBER.finditer(text, start, min(len(text), cluster.end() + 2)):
            yield m
            done = m.end()


def _numbers(text: str) -> Iterator[Entity]:
    for m in _number_matches(text):
        kind = m.lastgroup
        form = re.sub(r"[^0-9A-Z]", "", m[0])
        if kind == "ip":
            parts = m[0].split(".")
            if any(int(p) > 255 for p in parts):
                continue
            form = ".".join(str(int(p)) for p in parts)
        elif kind == "iban" and _iban_check(form[:2], form[4:]) != form[2:4]:
            continue
        elif kind == "phone":
            if not 8 <= len(form) <= 15:
                continue
            form = f"+{form}" if m[0][0] == "+" else f"+1{form}" if len(form) == 10 else form
        yield Entity(m.start(), m.end(), kind, form)


def _name_words(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The leading capitalised words between two places."""
    found = []
    for m in re.finditer(_WORD, text[start:end]):
        if not m[0][0].isupper():
            break
        found.append((start + m.start(), start + m.end()))
    return found


def _form(word: str) -> str:
    return word.title() if word.isupper() and len(word) > 1 else word


def _full_names(text: str) -> Iterator[Entity]:
    """Names after a title, and known given names with the names that follow."""
    for lead in _CAPITAL.finditer(text):
        word, start = lead[0], lead.start()
        if start and text[start - 1].isalnum():
            continue
        if word in _TITLE_GENDER and (m := _TITLED.match(text, start)):
            gender = _TITLE_GENDER[word]
        elif (word in _KNOWN or word in _KNOWN_UPPER) and (m := _NAMED.match(text, start)):
            given = _KNOWN_UPPER.get(word, word)
            script, gender = _KNOWN[given]
            if _name_words(text, m.start("rest"), m.end("rest")):
                yield Entity(start, lead.end(), f"given:{script}:{gender}", given)
        else:
            continue
        words = _name_words(text, m.start("rest"), m.end("rest"))
        for i, (a, b) in enumerate(words):
            form = _form(text[a:b])
            own = _KNOWN.get(form, ("", gender))[1]
            given = i < len(words) - 1
            yield Entity(a, b, f"given:{script_of(form)}:{own}" if given else f"family:{script_of(form)}", form)


def _names(text: str) -> Iterator[Entity]:
    """Full names, and where a name of theirs stands alone later in the text."""
    first: dict[str, Entity] = {}
    places = set()
    for e in _full_names(text):
        yield e
        places.add(e.start)
        if e.end - e.start > 1:
            first.setdefault(e.form, e)
    if not first:
        return
    for m in re.finditer(_WORD, text):
        start, word = m.start(), m[0]
        if not word[0].isupper() or start in places or start and (text[start - 1].isalnum() or text[start - 1] == "_"):
            continue
        for part in (word, re.split("['’]", word)[0]):  # Kennedy's
            known = first.get(_form(part))
            if known and known.start < start:
                yield Entity(start, start + len(part), known.kind, known.form)
                break


def find(text: str | None) -> list[Entity]:
    """The mentions of a text from left to right, the earlier kind first where two overlap."""
    taken: list[Entity] = []
    if text:
        for group in (_emails(text), _numbers(text), _names(text)):
            for e in sorted(group):
                i = bisect(taken, e)
                if (i == 0 or taken[i - 1].end <= e.start) and (i == len(taken) or e.end <= taken[i].start):
                    taken.insert(i, e)
    return taken


# --- surrogates -----------------------------------------------------------------


class Surrogates:
    """Surrogates of canonical forms under a secret key."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()
        self.of = lru_cache(maxsize=100_000)(self._of)

    def _number(self, *parts: object) -> int:
        data = "\x1f".join(map(str, parts)).encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def _mixed(self, tweak: str, digits: list[int], sizes: list[int]) -> list[int]:
        """A keyed permutation of numbers with these digits: each half moves by what the other one gives."""
        digits, half = list(digits), len(digits) // 2
        left, right = slice(0, half), slice(half, len(digits))
        for turn in range(ROUNDS):
            own, other = (left, right) if turn % 2 else (right, left)
            noise = self._number(tweak, sizes, turn, digits[other])
            for i in range(own.start, own.stop):
                if noise < 1 << 64:
                    noise = self._number(tweak, noise, i)
                noise, step = divmod(noise, sizes[i])
                digits[i] = (digits[i] + step) % sizes[i]
        return digits

    def _permuted(self, tweak: str, text: str) -> str:
        """A keyed permutation of the strings with the same classes of characters.

        Letters outside the alphabets are drawn by the whole text instead.
        """
        out = [
            ALPHABETS[1][self._number(tweak, text, i) % 26] if ch.isalpha() and ch not in _CLASS else ch
            for i, ch in enumerate(text)
        ]
        places = [i for i, ch in enumerate(text) if ch in _CLASS]
        letters = [ALPHABETS[_CLASS[text[i]]] for i in places]
        digits = [a.index(text[i]) for a, i in zip(letters, places, strict=True)]
        for i, a, d in zip(places, letters, self._mixed(tweak, digits, [len(a) for a in letters]), strict=True):
            out[i] = a[d]
        return "".join(out)

    def _walked(self, tweak: str, text: str, valid) -> str:
        """The permutation repeated until a form that is valid, if the first one is; stays one to one."""
        moved = self._permuted(tweak, text)
        while valid(text) and not valid(moved):
            moved = self._permuted(tweak, moved)
        return moved

    def _email(self, form: str, tweak: str) -> str:
        local, _, domain = form.partition("@")
        labels = domain.split(".")
        known = next((d for d in OPEN_DOMAINS if domain == d or domain.endswith("." + d)), None)
        if known is None:
            labels = [self._permuted(f"domain{tweak}", label) for label in labels[:-1]] + labels[-1:]
        return f"{self._permuted(f'local{tweak}', local)}@{'.'.join(labels)}"

    def _ip(self, form: str, tweak: str) -> str:
        def block(a: int, b: int) -> tuple[str, int]:
            """The kind of a network and how many bits may change in it."""
            if a in (10, 127):
                return str(a), 24
            if (a, b) == (192, 168):
                return "192", 16
            if a == 172 and 16 <= b < 32:
                return "172", 20
            return ("open", 32) if 0 < a < 224 else ("other", 32)

        parts = [int(x) for x in form.split(".")]
        name, free = block(*parts[:2])
        bits = [p >> (7 - i) & 1 for p in parts for i in range(8)]
        while True:  # ends, as it comes back to the address itself at last
            bits[32 - free :] = self._mixed(f"ip{name}{tweak}", bits[32 - free :], [2] * free)
            parts = [int("".join(map(str, bits[i : i + 8])), 2) for i in (0, 8, 16, 24)]
            if block(*parts[:2])[0] == name:
                return ".".join(map(str, parts))

    def _digits(self, kind: str, form: str, tweak: str) -> str:
        if kind == "card":  # the first digit and whether the check digit is right stay
            off = (int(form[-1]) - _luhn(form[:-1])) % 10
            body = form[0] + self._permuted(f"card{form[0]}{tweak}", form[1:-1])
            return body + str((_luhn(body) + off) % 10)
        if kind == "ssn":
            return self._walked(f"ssn{tweak}", form, lambda s: not re.match(r"000|666|9|\d{3}00|\d{5}0000", s))
        if form.startswith("+1"):  # area and exchange codes begin with 2 to 9
            return "+1" + self._walked(f"phone{tweak}", form[2:], lambda s: s[0] > "1" and s[3:4] > "1")
        keep = 3 if form[0] == "+" else 1
        return form[:keep] + self._permuted(f"phone{form[:keep]}{tweak}", form[keep:])

    def _iban(self, form: str, tweak: str) -> str:
        body = self._permuted(f"iban{form[:2]}{tweak}", form[4:].lower()).upper()
        return form[:2] + _iban_check(form[:2], body) + body

    def _name(self, kind: str, form: str, draw: int) -> str:
        part, script, *gender = kind.split(":")
        group = gender[0] if gender else ""
        known = GIVEN.get((script, group))
        if part == "given" and known and form in known and draw == 0:
            order = sorted(known, key=lambda n: self._number("given", n))
            return order[(order.index(form) + 1) % len(order)]
        number = self._number(kind, form, draw)
        number, extra = divmod(number, 2)
        word = ""
        for _ in range(3 + extra + draw // 4):
            number, i = divmod(number, len(PARTS[script]))
            word += PARTS[script][i]
        ends = ENDINGS[script, group]
        return (word + ends[number % len(ends)]).capitalize()

    def _of(self, kind: str, form: str, draw: int = 0) -> str:
        tweak = f"#{draw}" if draw else ""
        if kind == "email":
            return self._email(form, tweak)
        if kind == "ip":
            return self._ip(form, tweak)
        if kind == "iban":
            return self._iban(form, tweak)
        if ":" in kind:
            return self._name(kind, form, draw)
        return self._digits(kind, form, tweak)


def render(surrogate: str, mention: str, kind: str) -> str:
    """A surrogate in the notation of a mention: its separators and capitals."""
    if kind == "ip":
        return surrogate
    if ":" in kind:
        return surrogate.upper() if mention.isupper() and len(mention) > 1 else surrogate
    if kind == "email":
        return "".join(_upper(s) if m.isupper() else s for s, m in zip(surrogate, mention, strict=True))
    letters = iter(surrogate[-sum(map(str.isalnum, mention)) :])
    return "".join(next(letters) if ch.isalnum() else ch for ch in mention)


# --- over tables ---------------------------------------------------------------------


def _entities(docs: DataFrame, text: str, key: bytes) -> DataFrame:
    """The distinct entities of all texts with their first surrogates."""

    def run(batches):
        surrogates = Surrogates(key)
        for batch in batches:
            found = {(e.kind, e.form) for t in batch.column(0) for e in find(t.as_py())}
            rows = [(kind, form, surrogates.of(kind, form)) for kind, form in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["kind", "form", "surrogate"]
            )

    return docs.select(text).mapInArrow(run, "kind string, form string, surrogate string").distinct()


def _drawn_again(entities: DataFrame, key: bytes) -> DataFrame:
    """Rows ``(kind, form, surrogate, draw)`` with the next draw of each entity."""

    def make():
        surrogates = Surrogates(key)

        def apply(kinds: pa.Array, forms: pa.Array, draws: pa.Array):
            rows = zip(kinds.to_pylist(), forms.to_pylist(), draws.to_pylist(), strict=True)
            return [pa.array([surrogates.of(k, f, d) for k, f, d in rows], pa.string())]

        return apply

    return arrow_columns(entities, ["kind", "form", "draw"], "surrogate string", make)


def redrawn(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """Entities ``(kind, form, draw)`` that must not use their first surrogate.

    Within a type (``given`` and ``family`` names are one each, whatever their
    gender) no two entities share a surrogate and none keeps its own form. Of
    those that would share one, the first by form keeps it.
    """
    entities = _entities(docs, text, key).withColumn("draw", F.lit(0))
    entities = materialize(entities, "pii-entities")
    group = F.substring_index("kind", ":", 1)
    for _ in range(MAX_DRAWS):
        owners = entities.groupBy(group.alias("group"), "surrogate").agg(
            F.min(F.struct("draw", "form", "kind")).alias("first"), F.count("*").alias("n")
        )
        crowded = owners.filter("n > 1")
        clash = entities.withColumn("group", group).join(crowded, ["group", "surrogate"])
        clash = clash.filter(F.struct("draw", "form", "kind") != F.col("first")).select("kind", "form")
        own = entities.filter(F.col("surrogate") == F.col("form")).select("kind", "form")
        losers = materialize(clash.unionByName(own).distinct(), "pii-clashes")
        if losers.isEmpty():
            return entities.filter("draw > 0").select("kind", "form", "draw")
        kept = entities.join(losers, ["kind", "form"], "left_anti")
        again = entities.join(losers, ["kind", "form"]).withColumn("draw", F.col("draw") + 1)
        entities = materialize(kept.unionByName(_drawn_again(again, key).select(*kept.columns)), "pii-entities")
    raise RuntimeError("surrogates keep colliding")


def pseudonymize(spark: SparkSession, docs: DataFrame, key: bytes, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the entities in ``text`` replaced, and ``n_replaced`` (mentions).

    Null and empty texts stay as they are, and so does every text without an
    entity. Equal texts get equal results. A column ``n_replaced`` of the input is
    replaced. Columns come in the order of ``docs``, then ``n_replaced``.
    """
    rows = redrawn(docs, key, text).limit(MAX_REDRAWN + 1).collect()
    if len(rows) > MAX_REDRAWN:
        raise ValueError(f"more than {MAX_REDRAWN} entities drew again; add name parts")
    draws = spark.sparkContext.broadcast({(r.kind, r.form): r.draw for r in rows})

    def make():
        surrogates, again = Surrogates(key), draws.value

        def one(body: str | None) -> tuple[str | None, int]:
            found = find(body)
            if not found:
                return body, 0
            out, at = [], 0
            for e in found:
                new = surrogates.of(e.kind, e.form, again.get((e.kind, e.form), 0))
                out += [body[at : e.start], render(new, body[e.start : e.end], e.kind)]
                at = e.end
            return "".join([*out, body[at:]]), len(found)

        def apply(texts: pa.Array):
            results = [one(t.as_py()) for t in texts]
            return [pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.int64())]

        return apply

    order = [c for c in docs.columns if c.lower() != "n_replaced" and (keep is None or c in keep or c == text)]
    return arrow_columns(docs, [text], f"`{text}` string, n_replaced long", make, keep).select(*order, "n_replaced")
