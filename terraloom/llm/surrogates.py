"""Personal data replaced by keyed, type-consistent surrogates."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rows import as_columns, as_struct

#: Titles by the gender they show; given names by gender; family names; particles of names.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"), "n": ("Dr", "Prof")}
GIVEN = {
    "m": "Adam Albert Andreas Antonio Bernard Carlos Daniel David Diego Felix Francois Georg Hans Henri Hugo Jack James John Jorge Jules Karl Louis Lukas Marc Martin Max Michael Miguel Oliver Otto Pablo Paul Peter Pierre Robert Samuel Simon Stefan Thomas William".lower().split(),
    "f": "Alice Amelie Ana Anna Barbara Carmen Celine Charlotte Clara Elena Elisabeth Emma Eva Grace Hannah Helga Ines Ingrid Isabel Jane Julia Katrin Laura Lena Louise Lucia Margot Maria Marie Marta Mary Nina Olivia Petra Rosa Sabine Sarah Sofia Sophie Teresa".lower().split(),
}
FAMILY = "Adams Baker Becker Bernard Brown Clark Cooper Costa Cruz Davies Diaz Dubois Dupont Evans Ferrari Fischer Fontaine Garcia Girard Gomez Green Hall Harris Hoffmann Jackson Johnson Jones Keller King Klein Koch Lambert Laurent Leroy Lewis Lopez Marino Martinez Mercier Meyer Miller Moore Moreau Moreno Morris Navarro Neumann Ortega Parker Perez Petit Ramos Richter Rivera Robinson Romero Rossi Roussel Ruiz Sanchez Schmidt Schneider Schulz Scott Silva Smith Taylor Thompson Torres Turner Vidal Wagner Walker Weber Werner White Wilson Wolf Wright Young Zimmermann".lower().split()
PARTICLES = "van von der den de del della di da dos du la le ter zu".split()
#: Letters, and pairs of consonants, that stand for each other in names; pairs at a word's start and elsewhere.
LETTERS = ("aeiou", "bdfgklmnprstvz", "chjqwxy", "áéíóúàèìòùâêîôû", "äöü", "çñßšžč", "аеиоу", "бвгдзклмнпрст", "жйфхцчшщъыьэюяё", "αειουηω", "βγδκλμνπρστ", "ζθξφχψς")
PAIRS = ("bl br ch cl cr dr fl fr gl gr kl kr pl pr sh sk sl sm sn sp st sw th tr tw".split(), "ch ck ff ft ld lf lk ll lm lt mm mp nd ng nk nn ns nt pp rd rg rk rl rm rn rs rt sh sk ss st th tt tz".split())
#: Runs of characters that stand for each other within a script and case.
ALPHABETS = [(a, b) for a, b in ("09", "az", "AZ", "ßö", "øÿ", "ÀÖ", "ØÞ", "αω", "ΑΡ", "ΣΩ", "ая", "АЯ", "את", "ぁん", "ァン", "一龥", "가힣")]
#: How keys of known services begin.
KEY_HEADS = r"AKIA|ASIA|gh[pousr]_|sk-|AIza|xox[abprs]-"

_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_WORD = r"[^\W\d_a-zß-ÿа-я](?:[^\W\d_]+|(?=['’-]))(?:['’-][^\W\d_]+)*"
_FINDER = re.compile(
    r"(?P<email>[\w.+\-]+@[\w\-]+(?:\.[\w\-]+)+)"
    r"|(?P<lead>(?i:\b(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key)\b\s*[=:]\s*[\"']?))(?P<secret>[^\s\"'#&*$%|<>]{8,})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w+])\d(?:[ -]?\d){12,18}(?!\w))"
    r"|(?P<phone>(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]\d{2,5}){1,4}(?!\w)|(?<!\w)\+\d{8,15}(?!\w))"
    rf"|(?P<key>(?<!\w)(?:[0-9a-f]{{32,}}|(?:{KEY_HEADS})[\w-]{{16,}})(?!\w))"
    rf"|(?P<title>\b(?:(?:{_TITLE})\.? +)+)(?P<name>(?:[^\W\d_a-zß-ÿа-я]\. ?)*(?:{_WORD})(?: (?:(?:{'|'.join(PARTICLES)}) )*(?:{_WORD})){{0,2}})"
)
_MAYBE = re.compile(rf"[@0-9=:]|{KEY_HEADS}|{_TITLE}")


class Permuter:
    """Keyed permutations of ranges of integers, none of which leaves any value in place."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, x: int, bits: int) -> int:
        raw = hashlib.blake2b(tweak + bytes([i]) + x.to_bytes(bits // 8 + 1, "little"), key=self.key, digest_size=min(64, bits // 8 + 1)).digest()
        while len(raw) * 8 < bits:
            raw += hashlib.blake2b(raw, key=self.key).digest()
        return int.from_bytes(raw, "little") & ((1 << bits) - 1)

    def _walk(self, tweak: bytes, n: int, x: int, rounds: tuple[int, ...]) -> int:
        bits = ((n - 1).bit_length() + 1) // 2
        low = (1 << bits) - 1
        while True:  # until it falls into the range again
            a, b = x >> bits, x & low
            if rounds[0] == 0:
                for i in rounds:
                    a, b = b, a ^ self._round(tweak, i, b, bits)
            else:
                for i in rounds:
                    a, b = b ^ self._round(tweak, i, a, bits), a
            x = a << bits | b
            if x < n:
                return x

    def move(self, tweak: bytes, n: int, x: int) -> int:
        """A rotation seen through a Feistel permutation: one to one, and never x itself if n > 1."""
        if n < 2:
            return x
        step = 1 + int.from_bytes(hashlib.blake2b(tweak, key=self.key, digest_size=16).digest(), "little") % (n - 1)
        there = self._walk(tweak, n, x, tuple(range(8)))
        return self._walk(tweak, n, (there + step) % n, tuple(range(7, -1, -1)))


def _alphabet(c: str) -> tuple[int, int]:
    for a, b in ALPHABETS:
        if a <= c <= b:
            return ord(a), ord(b) - ord(a) + 1
    return ord(c), 1


def luhn(digits: str) -> int:
    """The check digit that these digits ask for."""
    return -sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10


@lru_cache(maxsize=256)
def _run(c: str) -> str:
    first, n = _alphabet(c)
    return "".join(map(chr, range(first, first + n)))


def segments(word: str) -> list[tuple[str | list[str], int]]:
    """A name in small letters as places in alphabets of letters or pairs: what stands there in another name of its form."""
    out, i = [], 0
    while i < len(word):
        pairs = PAIRS[i > 0]
        if (pair := word[i : i + 2]) in pairs:
            out.append((pairs, pairs.index(pair)))
        else:
            pair, letters = word[i], next((x for x in LETTERS if word[i] in x), None) or _run(word[i])
            out.append((letters, letters.index(pair)))
        i += len(pair)
    return out


def mod97(iban: str) -> int:
    """What remains of an IBAN, moved round as its check asks; 1 if it is valid."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


class Surrogates:
    """Finds entities in a text and replaces them; the same entity has the same surrogate everywhere.

    Surrogates are one to one among the values of one format, so that distinct entities stay distinct. Names are
    replaced word by word, family and given names each by their own rule, so that a person has one surrogate with
    any title and without; words of a name that a title shows are also replaced where they stand alone in the text.
    """

    REMEMBERED = 100_000

    def __init__(self, key: bytes):
        self.permuter = Permuter(key)
        self.known: dict[tuple[str, str], str] = {}
        self.told: set[tuple[str, str, str]] | None = None

    def _letters(self, kind: str, s: str, fits: Callable[[str], bool] = lambda s: True, hexed: bool = False) -> str:
        """Each character for one of its own alphabet; again until the value fits."""
        spots = [(ord("0"), 16) if hexed else _alphabet(c) for c in s]
        n = 1
        for _, size in spots:
            n *= size
        if n < 2:
            return s
        tweak = f"{kind}|{''.join(f'{a},{m};' for a, m in spots)}".encode()
        out = s
        while True:
            x = 0
            for (a, m), c in zip(spots, out):
                x = x * m + (int(c, 16) if hexed else ord(c) - a)
            x = self.permuter.move(tweak, n, x)
            signs = []
            for a, m in reversed(spots):
                x, d = divmod(x, m)
                signs.append("0123456789abcdef"[d] if hexed else chr(a + d))
            out = "".join(reversed(signs))
            if fits(out) or out == s:
                return out

    def _digits(self, kind: str, digits: str) -> str:
        return str(self.permuter.move(f"{kind}|{len(digits)}".encode(), 10 ** len(digits), int(digits))).zfill(len(digits)) if digits else ""

    def _email(self, s: str) -> str:
        local, _, host = s.partition("@")
        *labels, top = host.split(".")
        return self._letters("local", local) + "@" + ".".join([self._letters("host", x) for x in labels] + [top])

    def _ip(self, s: str) -> str:
        parts = [int(x) for x in s.split(".")]
        if max(parts) > 255:
            return ".".join(self._digits(f"dotted{i}", x) for i, x in enumerate(s.split(".")))
        x = self.permuter.move(b"ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def _card(self, s: str) -> str:
        """The first digit stays; so does the check digit's agreement with the others."""
        new = s[0] + self._digits("card", s[1:-1])
        return new + str((luhn(new) + int(s[-1]) - luhn(s[:-1])) % 10)

    def _secret(self, s: str) -> str:
        mixed = lambda x: bool(re.fullmatch(r"[0-9a-f]+", x) and re.search("[a-f]", x) and re.search("[0-9]", x))
        return self._letters("secret", s, mixed, True) if mixed(s) else self._letters("secret", s)

    def _spelled(self, kind: str, word: str, taken: tuple[list[str], ...]) -> str:
        """Another name of the same form, letters for letters of their kind; none of those taken."""
        parts = segments(word)
        n = 1
        for letters, _ in parts:
            n *= len(letters)
        form = [letters for letters, _ in parts]
        tweak = f"{kind}|{'|'.join(x[0] + str(len(x)) + ('.' if x is PAIRS[0] else '') for x in form)}".encode()
        while n > 1:
            x = 0
            for letters, i in parts:
                x = x * len(letters) + i
            x = self.permuter.move(tweak, n, x)
            signs = []
            for letters in reversed(form):
                x, i = divmod(x, len(letters))
                signs.append(letters[i])
            new = "".join(reversed(signs))
            parts = segments(new)
            if [letters for letters, _ in parts] == form:
                if new == word or not any(new in names for names in taken):
                    return new
            else:  # another form: go on from the same place
                parts = [(letters, letters.index(sign)) for letters, sign in zip(form, reversed(signs))]
        return word

    def _pooled(self, kind: str, word: str) -> str:
        """A family or given name, in small letters: for one of a list another of it, else another of its form."""
        pools = {"family": {"": FAMILY}, "given": GIVEN}[kind]
        for which, pool in pools.items():
            if word in pool:
                return pool[self.permuter.move(f"{kind}{which}".encode(), len(pool), pool.index(word))]
        return self._spelled(kind, word, tuple(pools.values()))

    def _iban(self, s: str) -> str:
        """The country stays; so does the check digits' distance from those that would be right."""
        right = lambda x: 98 - mod97(x[:2] + "00" + x[4:])
        new = s[:4] + self._letters("iban" + s[:2], s[4:])
        return f"{s[:2]}{(right(new) + int(s[2:4]) - right(s)) % 100:02d}{s[4:] if new == s else new[4:]}"

    def of(self, kind: str, entity: str) -> str:
        """The surrogate of an entity in its plain form (digits alone, small letters)."""
        if (got := self.known.get((kind, entity))) is None:
            if len(self.known) >= self.REMEMBERED:
                self.known.clear()
            if kind in ("family", "given"):
                got = self._pooled(kind, entity)
            elif kind in ("phone", "ssn"):
                got = self._digits(kind, entity)
            else:
                got = {"email": self._email, "ip": self._ip, "card": self._card, "secret": self._secret, "iban": self._iban, "initial": lambda x: self._letters("initial", x)}[kind](entity)
            self.known[kind, entity] = got
        if self.told is not None:
            self.told.add((kind, entity, got))
        return got

    def _word(self, kind: str, word: str) -> str:
        new = self.of(kind, word.lower())
        return new.upper() if word.isupper() and len(word) > 1 else "".join(y.upper() if not i or not new[i - 1].isalpha() else y for i, y in enumerate(new))

    def _person(self, name: str, people: dict[str, str]) -> str:
        """A name word by word: the last is the family's, those before are given names, particles stay. An initial
        becomes that of the surrogate of a given name that the text has shown, else another letter."""
        words = re.findall(r"[^\W\d_]\.|[^ .]+|[ .]+", name)
        last = max(i for i, w in enumerate(words) if w.strip(" ."))
        out = []
        for i, w in enumerate(words):
            if not w.strip(" .") or w in PARTICLES:
                out.append(w)
            elif w.endswith("."):
                known = next((x for x, kind in people.items() if kind == "given" and x[0] == w[0]), None)
                out.append((self._word("given", known)[0] if known else self.of("initial", w[0].lower()).upper()) + ".")
            else:
                out.append(self._word("family" if i == last else "given", w))
        return "".join(out)

    def _found(self, m: re.Match, people: dict[str, str]) -> tuple[str, int, int, str] | None:
        kind = m.lastgroup
        a, b = m.span(kind)
        s = m[kind]
        if kind == "email":
            s = s.rstrip(".-")
            b = a + len(s)
            new = self.of("email", s.lower()) if "@" in s else s
            return kind, a, b, "".join(y.upper() if x.isupper() and len(y.upper()) == 1 else y for x, y in zip(s, new))
        if kind in ("secret", "key"):
            head = re.match(KEY_HEADS, s)
            skip = head.end() if head else 0
            return "secret", a, b, s[:skip] + self.of("secret", s[skip:])
        if kind == "ip":
            return kind, a, b, self.of("ip", ".".join(str(int(x)) for x in s.split(".")))
        if kind == "name":
            return kind, a, b, self._person(s, people)
        plain = re.sub(r"[ .()-]", "", s)
        skip = 0
        if kind == "phone":
            code = re.match(r"\+\d{1,3}(?=[ .(-])", s)
            skip = len(code[0]) if code else s.startswith("+")
            plain = re.sub(r"\D", "", s[skip:])
            if len(plain) < 7 or (len(plain) < 9 and not re.search(r"[+()]", s)):
                return None
        new = iter(self.of(kind, plain))
        return kind, a, b, s[:skip] + "".join(next(new) if c.isalnum() else c for c in s[skip:])

    @staticmethod
    def _people(found: list[re.Match]) -> dict[str, str]:
        """The words of names that titles show in a text: family or given, family first where a word is both."""
        people: dict[str, str] = {}
        for m in found:
            if m.lastgroup == "name":
                *given, family = (w for w in re.findall(r"[^ .]+", m["name"]) if w not in PARTICLES)
                people.update({w: "given" for w in given if len(w) > 1 and w not in people})
                people[family] = "family"
        return people

    def replace(self, text: str | None) -> tuple[str | None, list[dict]]:
        """The text with surrogates, and where they stand in it: kind, start, end."""
        if not text or not _MAYBE.search(text):
            return text, []
        matches = list(_FINDER.finditer(text))
        people = self._people(matches)
        found = [x for m in matches if (x := self._found(m, people)) is not None]
        if people:
            bare = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(map(re.escape, {*people, *(w.upper() for w in people)}), key=len, reverse=True))})(?!\w)")
            kinds = {**{w.upper(): k for w, k in people.items()}, **people}
            gaps = zip([0, *(b for _, _, b, _ in found)], [*(a for _, a, _, _ in found), len(text)])
            found += [("name", m.start(), m.end(), self._word(kinds[m[0]], m[0])) for lo, hi in list(gaps) for m in bare.finditer(text, lo, hi)]
            found.sort(key=lambda x: x[1])
        out, spans, at, size = [], [], 0, 0
        for kind, a, b, new in found:
            out += [text[at:a], new]
            size += a - at
            spans.append({"kind": kind, "start": size, "end": size + len(new)})
            size, at = size + len(new), b
        return "".join(out) + text[at:], spans


_held: dict[bytes, Surrogates] = {}


def held(key: bytes) -> Surrogates:
    """The worker process's own generator for a key."""
    if key not in _held:
        _held.clear()
        _held[key] = Surrogates(key)
    return _held[key]


def _replaced(docs: DataFrame, key: bytes, text_col: str) -> DataFrame:
    """(row, new): each row's columns, and its text with surrogates and their places."""
    packed = docs.select(as_struct(docs, text_col).alias("row"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("text", pa.string()), ("entities", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])
        for batch in batches:
            new = [dict(zip(("text", "entities"), held(key).replace(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, kind)], ["row", "new"])

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], *T.StructType.fromDDL("new struct<text: string, entities: array<struct<kind: string, start: bigint, end: bigint>>>").fields]))


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str | None = "__entities", check: bool = True) -> DataFrame:
    """docs with surrogates in the text, and in spans_col (none if None; an input column of that name gives way) an
    array of structs: kind, start, end.

    Rows are independent and need no shuffle: a surrogate is a keyed function of the entity alone, so that it is the
    same in all documents. With check, all entities of all texts are first held against each other, in a pass of its own,
    and two that share a surrogate are an error. Null and empty texts stay; texts of any length are read whole; all other
    columns, whatever their names, and all rows stay; repeated rows get the same surrogates; an empty table gives an empty one.
    """
    if check and (twice := collisions(entities(docs, key, text_col)).limit(1).collect()):
        raise ValueError(f"two entities share a surrogate: kind {twice[0]['kind']}")
    done = _replaced(docs, key, text_col)
    kept = [c for c in docs.columns if spans_col is None or c.lower() != spans_col.lower()]
    spans = [] if spans_col is None else [F.col("new.entities").alias(spans_col)]
    return done.select(*as_columns(docs, text_col, F.col("new.text"), kept=kept), *spans)


def entities(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """(kind, entity, surrogate), distinct, in plain form: what pseudonymise() replaces. Entities are keyed hashes, not originals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = held(key)
            own.told = set()
            for t in batch.column(0).to_pylist():
                own.replace(t)
            rows, own.told = sorted(own.told), None
            mark = lambda x: hashlib.blake2b(x.encode(), key=own.permuter.key, digest_size=16).hexdigest()  # noqa: E731, B023
            cols = [[k for k, _, _ in rows], [mark(e) for _, e, _ in rows], [s for _, _, s in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["kind", "entity", "surrogate"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "kind string, entity string, surrogate string").distinct()


def collisions(found: DataFrame) -> DataFrame:
    """Surrogates that stand for two entities: none, if all is well."""
    return found.groupBy("kind", "surrogate").agg(F.countDistinct("entity").alias("n")).where("n > 1")
