"""Personal data replaced by keyed surrogates of the same type and format.

Detected are e-mail addresses, phone numbers (international and common national forms), card
numbers, national numbers, IPv4 and IPv6 addresses, IBANs with right check digits, secrets (in
quotes or assigned after a telling word, bearer tokens, keys with a known prefix, private keys in
PEM blocks), and names of people that have a title or a known given name. A name is
replaced part by part, so "Mr. Stone" and "John Stone" still share a surname. Given names keep
gender and script, numbers keep separators, length and a valid check digit, secrets keep their
alphabet, addresses keep their domain's ending and share a surrogate domain where they shared
one, and capitals stay capitals.

What an entity becomes depends on the key, its type and its canonical form alone, so it is the
same in all documents and runs. Surrogates are checked over the whole corpus: no two entities
of a type get the same one, and none gets one that is itself an entity of the corpus. Whoever
loses a clash draws again, with a longer form when short ones run out, until no clash is left.

Texts without a detection are passed through untouched and not shuffled. The others are written
once with their entities; an entity that occurs in any share of them is one row of the table
that these are joined with.

Rules for odd rows: a null or empty text stays as it is; repeated rows are replaced alike; rows
are told apart by a number of their own, so doc_id may be null or repeat; an empty table gives
no rows; other columns are passed through (``_row`` and ``_entities`` are reserved, and
``n_replaced`` is replaced).
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeloom.llm.tables import keep, ship

KEY = b"lifeloom"

#: Titles by gender: f, m, or n where they say nothing.
TITLES = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m", "Signor": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f",
    "Doña": "f", "Signora": "f", "Dr": "n", "Prof": "n", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
#: Given names by script and gender: both what is detected without a title and what is drawn from.
GIVEN = {
    ("LATIN", "f"): "Alice Barbara Claire Diana Elena Frances Greta Hannah Isabel Julia Katharina Laura".split(),
    ("LATIN", "m"): "Albert Bernard Charles Daniel Edward Frederic George Henry Jacob John Martin Peter".split(),
    ("CYRILLIC", "f"): "Анна Вера Галина Дарья Елена Ирина Мария Наталья Ольга Софья".split(),
    ("CYRILLIC", "m"): "Андрей Борис Виктор Григорий Дмитрий Иван Михаил Николай Павел Сергей".split(),
    ("GREEK", "f"): "Άννα Ελένη Ειρήνη Ζωή Μαρία Σοφία Χριστίνα".split(),
    ("GREEK", "m"): "Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Σταύρος".split(),
}
SURNAMES = {
    "LATIN": "Abbott Bauer Castro Dubois Ellis Fischer Garnier Hoffman Ibarra Jensen Keller Lambert Moreno Norris".split(),
    "CYRILLIC": "Белов Волков Громов Егоров Зайцев Козлов Лебедев Морозов Орлов Соколов".split(),
    "GREEK": "Αγγέλου Βασιλείου Γεωργίου Δημητρίου Ιωάννου Νικολάου Παππάς".split(),
}
#: Further given names that are detected; names that are common words too (Mark, Grace) are left out.
MORE_GIVEN = {
    "f": """Abigail Adele Agnes Alexandra Alicia Alison Amanda Amelia Amy Andrea Angela Anita Anna Anne Annette Antonia
        Ashley Astrid Audrey Beatrice Bettina Brenda Brigitte Camille Carla Carmen Carol Caroline Catherine Cecilia Chloe
        Christina Christine Clara Claudia Cynthia Deborah Debra Denise Dolores Donna Doris Dorothy Eleanor Elizabeth Emily
        Emma Erika Esther Eva Evelyn Fatima Gabriela Heather Heidi Helen Helga Ines Ingrid Irene Isabella Jacqueline Janet
        Jennifer Jessica Joan Johanna Josephine Joyce Juana Judith Julie Karen Katherine Kathleen Kimberly Kirsten Laurence
        Leah Linda Lisa Louise Lucia Lucy Magdalena Margaret Maria Marie Marta Martha Mary Megan Melissa Michelle Monica
        Nancy Natalie Nicole Nina Olivia Pamela Patricia Paula Petra Pilar Priya Rachel Rebecca Renate Rosa Ruth Sabine
        Samantha Sandra Sara Sarah Sharon Silvia Simone Sofia Sophia Sophie Stephanie Susan Susanne Teresa Theresa Ursula
        Valerie Vanessa Veronica Victoria Virginia Yasmin Yvonne Zoe""".split(),
    "m": """Aaron Adam Ahmed Alan Alejandro Alexander Alfred Ali Andreas Andrew Anthony Antoine Antonio Arthur Benjamin
        Bernd Brandon Brian Bruce Carl Carlos Christian Christopher David Dennis Diego Dieter Dominik Donald Douglas Eduardo
        Emil Enrique Eric Erik Ernst Ethan Eugene Felix Fernando Florian Francisco Frank Franz Gary Gerald Gerhard Gregory
        Hans Harold Heinz Helmut Henri Hugo Ian Isaac Jack Jacques James Jason Javier Jeffrey Jeremy Joachim Joel Johann
        Johannes Jonathan Jorge Jose Joseph Joshua Juan Julien Justin Karl Keith Kenneth Kevin Klaus Larry Lars Laurent
        Lawrence Leonard Louis Luca Lucas Luis Lukas Manuel Marco Marcus Markus Matthew Matthias Mehmet Michael Miguel Mohamed
        Mohammed Nathan Nicholas Nicolas Oliver Oscar Pablo Patrick Paul Pedro Philip Philippe Pierre Ralph Raymond Richard
        Robert Roger Ronald Rudolf Russell Ryan Samuel Scott Sebastian Sergio Simon Stefan Stephen Steven Theodore Thomas
        Timothy Tobias Uwe Victor Vincent Walter Werner William Wolfgang Xavier""".split(),
}
_GENDER = {n: g for g, names in MORE_GIVEN.items() for n in names} | {n: g for (_, g), names in GIVEN.items() for n in names}
#: Length of an IBAN by country.
IBAN = dict(
    AD=24, AE=23, AT=20, BE=16, BG=22, CH=21, CY=28, CZ=24, DE=22, DK=18, EE=20, ES=24, FI=18, FR=27, GB=22, GI=23, GR=27,
    HR=21, HU=28, IE=22, IL=23, IS=26, IT=27, LI=21, LT=20, LU=20, LV=21, MC=27, MT=31, NL=18, NO=15, PL=28, PT=25, RO=24,
    RS=22, SA=24, SE=24, SI=19, SK=24, SM=27, TR=26, UA=29,
)

_CAPITAL = r"[^\W\d_a-zà-öø-ÿа-яα-ω][^\W\d_]+(?:-[^\W\d_]+)?"
_PATTERNS = {
    "email": r"[\w.+-]*\w@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}",
    "pem": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?P<pem>(?:(?!-----)[\s\S]){16,20000})-----END",
    "prefixed": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)(?P<aws>[A-Z0-9]{16})|(?:gh[pousr]_|github_pat_|glpat-|sk[-_](?:live_|test_|proj-)?|xox[abprs]-|AIza)"
    r"(?P<known>(?=[\w-]*\d)[\w-]{20,}))(?![A-Za-z0-9])",
    "bearer": r"\b[Bb]earer\s+(?P<bearer>(?=[\w.~+/=-]*\d)[\w.~+/=-]{15,}[\w=])",
    "assigned": r"(?i:api[_-]?key|token|secret|passw(?:or)?d|[_-]key)[\w-]{0,20}(?:=(?P<tight>[A-Za-z0-9+/_=-]{16,})|"
    r"\s{0,2}[:=]\s{0,2}(?P<loose>(?=[A-Za-z+/_=-]*\d)(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{8,}))(?![\w(])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}",
    "ipv6": r"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:|::)(?:[0-9A-Fa-f]{0,4}:){1,6}[0-9A-Fa-f]{0,4}(?![\w:])",
    "secret": r"(?P<quote>[\"'])(?P<secret>[A-Za-z0-9+/_=-]{16,})(?P=quote)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<!\w)\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\w)",
    "national": r"(?<![\w+(.,-])(?:\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}(?P<dash>[.-])\d{3}(?P=dash)\d{4}|\(?0\d{2,4}\)?[ /-]\d{5,8}"
    r"|0\d(?P<gap>[ .-])\d{2}(?:(?P=gap)\d{2}){3})(?![ .,-]?\d|[\w-])",
    "card": r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w.]\d|\w)",
}
_STRUCTURED = re.compile("|".join(f"(?P<{k}_>{p})" for k, p in _PATTERNS.items()))
_SECRET_WORDS = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|key)\W{0,4}$")
_TITLED = re.compile(rf"\b(?P<title>{'|'.join(TITLES)})\b\.? (?P<first>{_CAPITAL})(?: (?P<last>{_CAPITAL}))?")
_KNOWN = re.compile(rf"\b(?P<first>{_CAPITAL})(?= (?P<last>{_CAPITAL}))")
#: Groups that hold the secret itself.
_INNER = ("secret", "pem", "aws", "known", "bearer", "tight", "loose")
_HINT = re.compile(r"[0-9@=]|-----BEGIN")
_TITLE_WORDS = [f"{t}{end}" for t in TITLES for end in (" ", ". ")]


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "LATIN").split()[0]
    return name if name in SURNAMES else "LATIN"


def name_parts(m: re.Match, gender: str) -> Iterator[tuple[int, int, str, str]]:
    first, last = m.group("first"), m.group("last")
    if last:
        yield m.start("first"), m.end("first"), f"given:{script_of(first)}:{gender}", first.lower()
    word, group = (last, "last") if last else (first, "first")
    yield m.start(group), m.end(group), f"surname:{script_of(word)}", word.lower()


def iban_of(text: str) -> str | None:
    """The beginning of a text as an IBAN with its spaces, if its length and check digits are right."""
    length, n = IBAN.get(text[:2], 0), 0
    for end, c in enumerate(text, 1):
        n += c != " "
        if n == length:
            whole = end == len(text) or text[end] == " "
            return text[:end] if whole and iban_rest(text[:end].replace(" ", "")) == 1 else None
    return None


def iban_rest(canon: str) -> int:
    return int("".join(str(int(c, 36)) for c in canon[4:] + canon[:4])) % 97


def ipv6_of(text: str) -> str | None:
    """The short form of an address of two groups or more."""
    try:
        found = str(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    return found if sum(map(bool, found.split(":"))) > 1 else None


def structured(text: str) -> Iterator[re.Match]:
    """All matches; after one that proves to be none the search goes on inside of it."""
    at = 0
    while m := _STRUCTURED.search(text, at):
        kind = m.lastgroup
        if kind == "iban_" and not iban_of(m.group()) or kind == "ipv6_" and not ipv6_of(m.group()):
            at = m.start() + 1
            continue
        yield m
        at = m.start() + len(iban_of(m.group())) if kind == "iban_" else m.end()


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of all detections, in order and apart."""
    found: list[tuple[int, int, str, str]] = []
    if _HINT.search(text) or '"' in text or "'" in text:
        for m in structured(text):
            kind = m.lastgroup.rstrip("_") if m.lastgroup and m.lastgroup.endswith("_") else "secret"
            kind = "phone" if kind == "national" else kind
            start, end = m.span()
            if kind in ("pem", "prefixed", "bearer", "assigned"):
                kind = "secret"
                group = next(g for g in _INNER if m.group(g))
                found.append((*m.span(group), kind, m.group(group)))
                continue
            if kind == "iban":
                end = start + len(iban_of(m.group()))
                found.append((start, end, kind, text[start:end].replace(" ", "")))
                continue
            if kind == "ipv6":
                found.append((start, end, kind, ipv6_of(m.group())))
                continue
            if kind == "secret":
                start, end = m.span("secret")
                if not _SECRET_WORDS.search(text, max(0, m.start() - 24), m.start()):
                    continue
            surface = text[start:end]
            if kind in ("phone", "card", "ssn"):
                surface = "".join(c for c in surface if c.isdigit())
            found.append((start, end, kind, surface.lower() if kind == "email" else surface))
    people = []
    if any(t in text for t in _TITLE_WORDS):
        for m in _TITLED.finditer(text):
            gender = TITLES[m.group("title")]
            gender = _GENDER.get(m.group("first"), "n") if gender == "n" else gender
            people += name_parts(m, gender)
    for m in _KNOWN.finditer(text):
        gender = _GENDER.get(m.group("first").split("-")[0])
        people += name_parts(m, gender) if gender else ()
    out: list[tuple[int, int, str, str]] = []
    for d in sorted({*found, *people}, key=lambda d: (d[0], -d[1], d[2])):
        if not out or d[0] >= out[-1][1]:
            out.append(d)
    return out


class Draw:
    """Numbers that only the key, type, canonical form and attempt decide."""

    def __init__(self, key: bytes, kind: str, canon: str, attempt: int) -> None:
        seed = hmac.new(key, f"{kind}\0{canon}\0{attempt}".encode(), hashlib.sha256).digest()
        self.stream = self.numbers(seed)

    @staticmethod
    def numbers(seed: bytes) -> Iterator[int]:
        i = 0
        while True:
            block = hashlib.sha256(seed + i.to_bytes(4, "big")).digest()
            yield from (int.from_bytes(block[k : k + 4], "big") for k in range(0, 32, 4))
            i += 1

    def below(self, n: int) -> int:
        return next(self.stream) % n

    def pick(self, among: list[str] | str) -> str:
        return among[self.below(len(among))]

    def like(self, text: str) -> str:
        """Letters for letters and digits for digits, of the same case and script; hex stays hex."""
        letters = {c.lower() for c in text if c.isalpha()}
        hexadecimal = bool(letters) and letters <= set("abcdef") and any(c.isdigit() for c in text)
        out = []
        for c in text:
            if c.isdigit():
                out.append(self.pick("0123456789"))
            elif c.isalpha():
                script = script_of(c)
                few = {"LATIN": "abcdefghijklmnopqrstuvwxyz", "CYRILLIC": "абвгдежзиклмнопрстуфхцч", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω"}
                new = self.pick("abcdef" if hexadecimal else few[script])
                out.append(new.upper() if c.isupper() else new)
            else:
                out.append(c)
        return "".join(out)


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The canonical form that stands for an entity."""
    draw = Draw(key, kind, canon, attempt)
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        head, _, ending = domain.rpartition(".")
        return f"{draw.like(local)}{'x' * (attempt // 8)}@{Draw(key, 'domain', domain, 0).like(head)}.{ending}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind in ("phone", "card", "ssn"):
        new = canon[0] + draw.like(canon[1:])
        if kind == "card" and luhn(canon) == 0:
            new = next(new[:-1] + d for d in "0123456789" if luhn(new[:-1] + d) == 0)
        return new
    if kind == "secret":
        return draw.like(canon)
    if kind == "iban":
        new = f"{canon[:2]}00{draw.like(canon[4:])}"
        return f"{new[:2]}{98 - iban_rest(new):02d}{new[4:]}"
    if kind == "ipv6":
        first = ipaddress.IPv6Address(canon).exploded.split(":")[0]
        return str(ipaddress.IPv6Address(":".join([first, *(f"{1 + draw.below(65535):x}" for _ in range(7))])))
    what, script, *gender = kind.split(":")
    if what == "surname":
        names = SURNAMES[script]
    else:
        names = [n for g in ("f", "m") if gender[0] in (g, "n") for n in GIVEN[script, g]]
    return "-".join(draw.pick(names) for _ in range(1 + attempt // 4)).lower()


def poured(surface: str, kind: str, new: str) -> str:
    """A surrogate in the shape of the mention that it replaces."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in surface)
    if kind == "iban":
        signs = iter(new)
        return "".join(c if c == " " else next(signs) for c in surface)
    if kind.startswith(("given", "surname")):
        return new.upper() if surface.isupper() else "-".join(p.capitalize() for p in new.split("-"))
    return new.upper() if kind == "email" and surface.isupper() else new


ENTITY = "array<struct<kind: string, canon: string>>"


def split_off(schema: T.StructType, detected: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with detections, and their distinct entities; or the rows without any."""
    at = schema.fieldNames().index("text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("canon", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [detect(t) if t else [] for t in b.column(at).to_pylist()]
            mask = pa.array([bool(f) == detected for f in found], pa.bool_())
            if detected:
                own = [sorted({(k, c) for _, _, k, c in f}) for f in found if f]
                own = pa.array([[{"kind": k, "canon": c} for k, c in e] for e in own], kind)
                cut = b.filter(mask)
                yield pa.RecordBatch.from_arrays([*cut.columns, own], [*b.schema.names, "_entities"])
            else:
                yield b.filter(mask)

    return work


def drawn(key: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)
            new = [surrogate(key, *r) for r in rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], ["kind", "canon", "attempt", "new"])

    return work


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, new) of all distinct entities; ``new`` is unique per type and not an entity.

    Types that look alike in a text (given names of all kinds, and surnames) share one name space.
    """
    space = F.split("kind", ":")[0]
    given = entities.select(space.alias("space"), F.col("canon").alias("new")).distinct()
    schema = "kind string, canon string, attempt int, new string"
    pending = entities.select("kind", "canon", F.lit(0).alias("attempt"))
    taken = None
    while True:
        tried = keep(pending.mapInArrow(drawn(key), schema).withColumn("space", space), "tried")
        clash = tried.join(given, ["space", "new"], "left_semi")
        free = tried.join(given, ["space", "new"], "left_anti")
        if taken is not None:
            held = taken.select("space", "new")
            clash = clash.unionByName(free.join(held, ["space", "new"], "left_semi"))
            free = free.join(held, ["space", "new"], "left_anti")
        rank = F.struct(F.xxhash64("canon"), "kind", "canon")
        best = free.groupBy("space", "new").agg(F.min(rank).alias("best"))
        judged = free.join(best, ["space", "new"]).withColumn("won", rank == F.col("best"))
        won = keep(judged.filter("won").select("kind", "canon", "new", "space"), "surrogates")
        lost = clash.select("kind", "canon", "attempt").unionByName(
            judged.filter("not won").select("kind", "canon", "attempt")
        )
        taken = won if taken is None else taken.unionByName(won)
        pending = keep(lost.withColumn("attempt", F.col("attempt") + 1), "pending")
        if pending.isEmpty():
            return taken.select("kind", "canon", "new")


def replaced(schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    at = schema.fieldNames().index("text")
    width = len(schema) - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            maps = b.column(width).to_pylist()
            for text, pairs in zip(b.column(at).to_pylist(), maps, strict=True):
                new = {(p["kind"], p["canon"]): p["new"] for p in pairs}
                parts, last = [], 0
                found = detect(text)
                for start, end, kind, canon in found:
                    parts += [text[last:start], poured(text[start:end], kind, new[kind, canon])]
                    last = end
                texts.append("".join(parts) + text[last:])
                counts.append(len(found))
            cols = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(width)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], schema.fieldNames())

    return work


def pseudonymise(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """The documents with surrogates in their texts, and ``n_replaced``, the number of replacements."""
    ship(docs.sparkSession)
    docs = docs.drop("n_replaced").withColumn("text", F.col("text").cast("string"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    out = T.StructType([*docs.schema.fields, T.StructField("n_replaced", T.LongType())])
    with_entities = T.StructType([*docs.schema.fields, T.StructField("_entities", T._parse_datatype_string(ENTITY))])
    marked = docs.mapInArrow(split_off(docs.schema, True), with_entities)
    marked = keep(marked.withColumn("_row", F.monotonically_increasing_id()), "marked")
    each = marked.select("_row", F.inline("_entities"))
    entities = keep(each.select("kind", "canon").distinct(), "entities")
    known = surrogates(entities, key)
    maps = each.join(known, ["kind", "canon"]).groupBy("_row").agg(
        F.collect_list(F.struct("kind", "canon", "new")).alias("_map")
    )
    changed = marked.join(maps, "_row").select(*names, "_map").mapInArrow(replaced(out), out)
    plain = docs.mapInArrow(split_off(docs.schema, False), docs.schema)
    return plain.withColumn("n_replaced", F.lit(0).cast("long")).unionByName(changed)
