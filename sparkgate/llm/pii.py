"""Personal data and secrets replaced by surrogates.

Method: entities are detected in whole texts; every distinct entity gets a replacement drawn
with a keyed hash, of its own type and form: digits stay digits, letters letters of the same
case, a card number keeps its length, first digit and check-sum validity, an address its
valid octets, a phone number its country code, a person the gender of the title and the
script of the name. The draw depends on the entity alone, so all its mentions, in any writing
and any document, get the same replacement (coreference). A collision check over all
entities draws again where two would get the same replacement, or one equals a real entity,
until all are distinct. Names get a further syllable every second draw; what still clashes
after ``IN_FORM`` draws (the form has too few values, as that of ``1@a.de``) gets one more
character in each further draw, so that the rounds end for any number of entities. Secrets of
symbols alone, masks like ``********`` among them, get other symbols.

Entities are a small share of the texts. They are written to a table, with one row for texts
that are equal; the replacements are joined back by the text's digest, broadcast only up to
``TEXTS_BROADCAST`` texts with entities (they are counted first) and by a shuffle join beyond.
No text goes through Python a second time.

Nulls, ties and odd rows: a null text stays null, a text without entities stays as it is;
every input row gives one output row, repeated rows included; where patterns overlap, the
earlier in ``PATTERNS`` wins, then the one that starts first; other columns are kept; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sparkgate.llm.common import short_batches, slices
from sparkgate.session import materialize

#: Texts with entities of which the replacements are broadcast.
TEXTS_BROADCAST = 100_000
#: Draws of an entity's own length; later ones are longer by one more character each.
IN_FORM = 8
FOUND = "digest string, found array<struct<start: int, stop: int, kind: string, canon: string, written: string>>"

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Titles by gender, and words that can stand in a name.
TITLES = {"female": "Mrs Ms Miss Madam Lady Frau Madame Mme Mademoiselle Señora Señorita Sra Signora Г-жа Госпожа Κυρία",
          "male": "Mr Mister Sir Lord Herr Herrn Monsieur Señor Signor Г-н Господин Κύριος"}
_NAME = r"[^\W\d_a-z][^\W\d_A-Z][^\W\d_]*(?:[-'’][^\W\d_]+)?"


def _person(gender: str) -> re.Pattern:
    titles = "|".join(TITLES[gender].split())
    return re.compile(rf"(?<!\w)(?:{titles})\.?[ ]({_NAME}(?: {_NAME})?)(?!\w)")


#: Kind, pattern and what a text needs for the pattern to be tried. Group 1, if any, is the entity.
PATTERNS: list[tuple[str, re.Pattern, str]] = [
    ("secret", re.compile(r"(?i)(?<![a-z])(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)"
                          r"[\"']?\s*[=:]\s*[\"']?([^\s\"'<>,;]{6,})"), "=:"),
    ("key", re.compile(r"(?<!\w)(?:AKIA|ASIA|AROA|AIDA)[0-9A-Z]{16}(?!\w)"), "A"),
    ("key", re.compile(r"(?<!\w)(?:sk-[A-Za-z0-9-]{20,}|gh[opsu]_[A-Za-z0-9]{30,}|xox[bp]-[A-Za-z0-9-]{10,})"), "_-"),
    ("email", re.compile(r"(?<![\w.+-])[\w.+%-]*\w@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}(?!\w)"), "@"),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"), "0123456789"),
    ("ip", re.compile(rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)"), "."),
    ("card", re.compile(r"(?<![\w+])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)"),
     "0123456789"),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), "-"),
    ("phone", re.compile(r"(?<![\w+.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"),
     "0123456789"),
    ("phone", re.compile(r"(?<!\w)\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\w)"), "+"),
    ("hex", re.compile(r"(?<!\w)(?=\w*\d)[0-9a-f]{32,}(?!\w)"), "0123456789"),
    ("female", _person("female"), " "),
    ("male", _person("male"), " "),
]
_DIGIT = re.compile(r"[0-9@=:]")
_TITLE = re.compile(r"(?<!\w)(?:" + "|".join((TITLES["female"] + " " + TITLES["male"]).split()) + r")\.? ")
DIGITS = ("card", "ssn", "phone")
PERSON = ("female", "male")


def canonical(kind: str, written: str) -> str:
    """What all writings of an entity have in common."""
    if kind in DIGITS:
        return re.sub(r"\D", "", written)
    if kind == "iban":
        return written.replace(" ", "")
    return written.lower() if kind == "email" else written.title() if kind in PERSON else written


def detect(text: str) -> list[tuple[int, int, str, str, str]]:
    """``start, stop, kind, canon, written`` of the entities, in order, without overlaps."""
    if not text:
        return []
    digits, titles = _DIGIT.search(text), _TITLE.search(text)
    if not digits and not titles:
        return []
    taken: list[tuple[int, int, str, str, str]] = []
    for kind, pattern, needs in PATTERNS:
        if not (titles if kind in PERSON else digits) or not any(c in text for c in needs):
            continue
        for m in pattern.finditer(text):
            a, b = m.span(m.re.groups)
            if not any(a < y and x < b for x, y, *_ in taken):
                taken.append((a, b, kind, canonical(kind, m[m.re.groups]), m[m.re.groups]))
    return sorted(taken)


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


class _Draw:
    """A keyed stream of choices for one entity and draw."""

    def __init__(self, key: bytes, kind: str, canon: str, turn: int):
        self.seed = hashlib.blake2b(f"{kind}\0{canon}\0{turn}".encode("utf-8", "surrogatepass"), key=key).digest()
        self.left, self.block = 0, 0

    def below(self, n: int) -> int:
        if self.left < n * 1000:
            more = hashlib.blake2b(self.block.to_bytes(8, "big"), key=self.seed).digest()
            self.left, self.block = int.from_bytes(more, "big"), self.block + 1
        self.left, k = divmod(self.left, n)
        return k

    def of(self, choices):
        return choices[self.below(len(choices))]


#: Given names by gender and script, and syllables that surnames are made of.
GIVEN = {
    ("female", "latin"): "Anna Clara Diana Elena Emma Flora Gina Helena Ida Julia Laura Lena Maria Nina Olivia Paula Rosa Sara Teresa Vera".split(),
    ("male", "latin"): "Adam Bruno Carl David Emil Felix Hugo Ivan Jonas Karl Leo Martin Nils Oscar Paul Robert Simon Thomas Victor Walter".split(),
    ("female", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Полина Юлия".split(),
    ("male", "cyrillic"): "Антон Борис Виктор Денис Иван Кирилл Максим Николай Олег Павел".split(),
    ("female", "greek"): "Άννα Δάφνη Ειρήνη Ελένη Ζωή Θάλεια Μαρία Νίκη Σοφία Χλόη".split(),
    ("male", "greek"): "Άρης Βασίλης Γιώργος Δημήτρης Ηλίας Κώστας Λευτέρης Μάριος Νίκος Πέτρος".split(),
}
SYLLABLES = {"latin": "ba bel car dan der el fen gar hol in ka lan mar nor os per ran sel tor ul ven wal zan".split(),
             "cyrillic": "ба вел гор дан ер зан кар лов мар нов ор пет ров сел тор ус фед чер".split(),
             "greek": "βα γεν δω ερ ζα θε κα λου μα νικ ου πα ρω στα τρι φω χα".split()}


SYMBOLS = "!#$%&()*+-./:=?@[]^_{|}~"


def script(name: str) -> str:
    for c in name:
        if "Ѐ" <= c <= "ԯ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
    return "latin"


def _shape(draw: _Draw, text: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    return "".join(draw.of("0123456789") if c.isdigit() else draw.of(letters) if c.islower() else
                   draw.of(letters.upper()) if c.isupper() else draw.of(letters) if c.isalpha() else c for c in text)


def surrogate(key: bytes, kind: str, canon: str, turn: int) -> str:
    """The replacement of an entity in its canonical form."""
    draw = _Draw(key, kind, canon, turn)
    more = max(0, turn + 1 - IN_FORM)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4 + more))
    if kind == "card":
        body = canon[0] + _shape(draw, canon[1:-1] + "0" * more)
        ends = [d for d in "0123456789" if luhn(body + d) == luhn(canon)]
        return body + draw.of(ends)
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}" + _shape(draw, "0" * more)
    if kind == "phone":
        keep = max(0, len(canon) - 10)
        return canon[:keep] + str(2 + draw.below(8)) + _shape(draw, canon[keep + 1:] + "0" * more)
    if kind == "email":
        local, host = canon.rsplit("@", 1)
        labels = host.split(".")
        return _shape(draw, local + "a" * more) + "@" + ".".join([_shape(draw, x) for x in labels[:-1]] + labels[-1:])
    if kind in PERSON:
        form = script(canon)
        words = canon.split(" ")
        last = "".join(draw.of(SYLLABLES[form]) for _ in range(4 + turn // 2)).capitalize()
        return draw.of(GIVEN[kind, form]) + " " + last if len(words) > 1 else last
    if kind in ("key", "iban"):
        return canon[:4] + _shape(draw, canon[4:] + "0" * more)
    if not any(c.isalnum() for c in canon):
        return "".join(draw.of(SYMBOLS) for _ in range(len(canon) + more))
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", canon)
    if not hexadecimal:
        return _shape(draw, canon + "a" * more)
    alphabet = "0123456789" + ("ABCDEF" if canon != canon.lower() else "abcdef")
    return "".join(draw.of(alphabet) for _ in range(len(canon) + more))


def rendered(kind: str, written: str, new: str) -> str:
    """A canonical replacement in the writing of one mention."""
    if kind in DIGITS:
        rest = iter(new)
        return "".join(next(rest) if c.isdigit() else c for c in written) + "".join(rest)
    if kind == "iban" and " " in written:
        rest = iter(new)
        return "".join(" " if c == " " else next(rest) for c in written) + "".join(rest)
    if kind in (*PERSON, "email") and written.isupper():
        return new.upper()
    return new


def _find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in slices(frames, "text"):
        rows = [(hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest(), found)
                for t in frame["text"] if (found := detect(t))]
        if rows:
            yield pd.DataFrame({"digest": [d for d, _ in rows], "found": [
                [dict(zip(("start", "stop", "kind", "canon", "written"), e)) for e in f] for _, f in rows]})


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``digest, found``: the entities of each different text that has any."""
    short_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return texts.mapInPandas(_find, FOUND).dropDuplicates(["digest"])


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, canon, new``: distinct replacements for distinct ``kind, canon``."""
    drawn = F.pandas_udf(lambda kind, canon, turn: pd.Series(
        [surrogate(key, k, c, t) for k, c, t in zip(kind, canon, turn)], dtype=object), StringType())
    now = entities.select("kind", "canon", F.lit(0).alias("turn"))
    while True:
        now = materialize(now.withColumn("new", drawn("kind", "canon", "turn")), "pii-draw")
        first = now.groupBy("kind", "new").agg(F.min("canon").alias("first"))
        real = now.select("kind", F.col("canon").alias("new"), F.lit(True).alias("real"))
        checked = materialize(now.join(first, ["kind", "new"]).join(real, ["kind", "new"], "left").withColumn(
            "clash", F.col("real").isNotNull() | (F.col("first") != F.col("canon"))), "pii-check")
        if not checked.where("clash").take(1):
            return now.drop("turn")
        now = checked.select("kind", "canon", (F.col("turn") + F.col("clash").cast("int")).alias("turn"))


def replacements(found: DataFrame, key: bytes) -> DataFrame:
    """``digest, parts``: for each text the spans to replace, in order, and by what."""
    mentions = materialize(found.select("digest", F.inline("found")), "pii-mentions")
    new = assign(mentions.select("kind", "canon").distinct(), key)
    write = F.pandas_udf(lambda kind, written, new: pd.Series(
        [rendered(k, w, n) for k, w, n in zip(kind, written, new)], dtype=object), StringType())
    joined = mentions.join(new, ["kind", "canon"]).withColumn("by", write("kind", "written", "new"))
    return joined.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "by"))).alias("parts"))


def _spliced(text: Column, parts: Column) -> Column:
    """``text`` with the spans of ``parts`` replaced."""
    def piece(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get(parts, i - 1)["stop"], F.lit(0))
        return F.concat(F.substring(text, before + 1, x["start"] - before), x["by"])
    last = F.element_at(parts, -1)["stop"]
    rest = F.substring(text, last + 1, F.length(text))
    return F.array_join(F.concat(F.transform(parts, piece), F.array(rest)), "")


def pseudonymize(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with the entities in its text replaced; ``count_col`` gets how many were."""
    parts = materialize(replacements(materialize(find(docs, text_col), "pii-found"), key), "pii-parts")
    mine = parts.withColumnsRenamed({"digest": "_digest", "parts": "_parts"})
    if parts.count() <= TEXTS_BROADCAST:
        mine = F.broadcast(mine)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    both = row.join(mine, F.md5(F.col("row")[text_col].cast("binary")) == F.col("_digest"), "left")
    text = F.when(F.col("_parts").isNull(), F.col("row")[text_col]).otherwise(
        _spliced(F.col("row")[text_col], F.col("_parts")))
    out = both.select("row.*", text.alias("_text"), F.coalesce(F.size("_parts"), F.lit(0)).cast("bigint").alias("_n"))
    columns = [F.col("_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != count_col]
    return out.select(*columns, *([F.col("_n").alias(count_col)] if count_col else []))
