"""Personal data and secrets, replaced by keyed surrogates of the same kind.

A mention is reduced to its entity (digits of a number, lower-cased address, name
without its title), so that all spellings of one entity share one surrogate.  The
surrogate comes from a keyed hash and keeps type, script, gender, length, case
and punctuation.  A table of all entities checks that no two share a surrogate
and that none is another's original; those that clash draw again.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.session import materialise

# Titles with their gender, and given and family names by script.
TITLES = {"Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m",
          "господин": "m", "Господин": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Sra": "f",
          "Doña": "f", "госпожа": "f", "Госпожа": "f",
          "Dr": "n", "Prof": "n", "Professor": "n", "доктор": "n", "Доктор": "n"}
GIVEN = {
    "latin m": ["Adam", "Bruno", "Carl", "David", "Erik", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin",
                "Nils", "Oscar", "Paul", "Robert", "Simon", "Thomas", "Victor"],
    "latin f": ["Anna", "Berta", "Clara", "Diana", "Emma", "Frida", "Greta", "Helena", "Irene", "Julia", "Katrin", "Laura", "Maria",
                "Nora", "Olivia", "Paula", "Rosa", "Sofia", "Teresa", "Vera"],
    "cyrillic m": ["Андрей", "Борис", "Виктор", "Григорий", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей"],
    "cyrillic f": ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Надежда", "Ольга", "Татьяна"],
}
FAMILY = {
    "latin": ["Albers", "Berger", "Castell", "Dorman", "Engels", "Fischer", "Garner", "Holm", "Iversen", "Jansen", "Keller", "Lindner",
              "Marchand", "Norden", "Olsen", "Petersen", "Quist", "Renard", "Steiner", "Tellier", "Ulmer", "Vidal", "Werner", "Zander"],
    "cyrillic m": ["Белов", "Волков", "Громов", "Егоров", "Жуков", "Зайцев", "Котов", "Лебедев", "Морозов", "Орлов"],
    "cyrillic f": ["Белова", "Волкова", "Громова", "Егорова", "Жукова", "Зайцева", "Котова", "Лебедева", "Морозова", "Орлова"],
}
SYLLABLES = {"latin": "ba de fi go lu ma ne ri so ta ve zo".split(), "cyrillic": "ба де ги ко лу ма не ри со та ве зо".split()}

_NAME = r"[^\W\d_a-zа-яß-öø-ÿ][\w'’-]*"
PATTERN = re.compile("|".join([
    r"(?P<block>-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----)",
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})",
    r"(?P<access>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b)",
    r"(?P<secret>(?<=[=:])(?<!::)(?:(?<=token[=:])|(?<=passwd[=:])|(?<=secret[=:])|(?<=password[=:])|(?<=api_key[=:])|(?<=apikey[=:]))[\"']?[^\s\"']{6,}"
    r"|(?<=[\"'])(?:(?<=token = [\"'])|(?<=token: [\"'])|(?<=secret = [\"'])|(?<=secret: [\"'])|(?<=api_key = [\"'])|(?<=password = [\"'])|(?<=password: [\"']))[^\s\"']{6,}"
    r"|\b(?:gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|[0-9a-fA-F]{32,})\b)",
    r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w))",
    r"(?P<ip6>(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:]))",
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<card>(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-]))",
    r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}(?!\w)|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-]))",
    rf"(?P<name>(?<!\w)(?:{'|'.join(sorted(TITLES, key=len, reverse=True))})\.? {_NAME}(?: {_NAME})?)",
]))
#: What a mention of any kind cannot be without: emails have @, numbers two digits in a row or a digit on both sides of a point,
#: IPv6 and secrets after a keyword : or =, the rest one of these literals, or is 32 hex digits.
_NEEDS = re.compile(r"[@=:]|\d\d|\d\.\d")
_LITERALS = ["PRIVATE KEY", "AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", *sorted(TITLES)]
_HEX = re.compile(r"[0-9a-fA-F]{32}")

#: Draws after which a format counts as exhausted (few free values, or nothing in it that can change).
LAST_DRAW = 12


def split_name(mention: str) -> tuple[str, str, list[str]]:
    """(title with blank, gender, names)."""
    title, names = re.match(r"(\S+ )(.*)", mention, re.S).groups()
    return title, TITLES[title.rstrip(". ")], names.split(" ")


def entity_of(kind: str, mention: str) -> str:
    """What all spellings of the same entity share."""
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", mention)
    if kind in ("email", "ip6"):
        return mention.lower()
    if kind == "iban":
        return mention.replace(" ", "")
    if kind == "name":
        _, gender, names = split_name(mention)
        return gender + " " + " ".join(names).casefold()
    return mention


def mentions(text: str | None) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, entity) of all mentions in a whole text.  A secret
    without a letter or digit is masked already and no mention."""
    if not text or not (_NEEDS.search(text) or any(x in text for x in _LITERALS) or _HEX.search(text)):
        return
    for match in PATTERN.finditer(text):
        if match.lastgroup == "secret" and not any(map(str.isalnum, match[0])):
            continue
        yield match.start(), match.end(), match.lastgroup, entity_of(match.lastgroup, match[0])


class Source:
    """Keyed numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self._seed, self._key, self._pool, self._n = f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass"), key, b"", 0

    def below(self, n: int) -> int:
        if len(self._pool) < 4:
            self._pool += hmac.new(self._key, self._seed + b"\0%d" % self._n, hashlib.sha256).digest()
            self._n += 1
        value, self._pool = int.from_bytes(self._pool[:4], "big"), self._pool[4:]
        return value % n

    def like(self, text: str, hexadecimal: bool = False) -> str:
        """Digits for digits of the same script, Latin and Cyrillic letters for such
        letters of the same case, the rest as it is."""
        out = []
        for c in text:
            if "0" <= c <= "9":
                out.append("0123456789abcdef"[self.below(16)] if hexadecimal else "0123456789"[self.below(10)])
            elif hexadecimal and c.lower() in "abcdef":
                x = "0123456789abcdef"[self.below(16)]
                out.append(x.upper() if c.isupper() else x)
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(26)))
            elif c.isdecimal():
                out.append(chr(ord(c) - int(c) + self.below(10)))
            elif "а" <= c <= "я" or "А" <= c <= "Я":
                out.append(chr(ord("а" if c.islower() else "А") + self.below(32)))
            else:
                out.append(c)
        return "".join(out)


def _luhn(digits: str) -> int:
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10


def surrogate_entity(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The surrogate of an entity, itself an entity of the same kind and format.
    Where ``LAST_DRAW`` draws were void, the format has no room: then it is a number
    in brackets after the kind.  Names grow by syllables instead."""
    source = Source(key, kind, entity, attempt)
    if attempt >= LAST_DRAW and kind != "name":
        return f"[{kind} {source.below(1 << 32):08x}{source.below(1 << 32):08x}]"
    if kind == "email":
        name, domain = entity.split("@")
        inner, top = domain.rsplit(".", 1)
        return f"{source.like(name)}@{source.like(inner)}.{top}"
    if kind == "ip":
        private = entity.startswith(("10.", "127.", "192.168."))
        keep = 2 if entity.startswith("192.168.") else int(private)
        octets = entity.split(".")
        if keep == 2 and attempt > 3:  # 65 536 addresses may all be in use: on to the larger private block
            octets, keep = ["10", *octets[1:]], 1
        return ".".join(octets[:keep] + [str(1 + source.below(254)) for _ in octets[keep:]])
    if kind == "ip6":
        return source.like(entity, hexadecimal=True)
    if kind == "phone":
        keep = 1 if len(entity) > 10 else 0  # the first digit of the country code
        lead = entity[keep]
        return entity[:keep] + chr(ord(lead) - int(lead) + 1 + source.below(9)) + source.like(entity[keep + 1:])
    if kind == "ssn":
        return source.like(entity)
    if kind == "card":
        digits = str(1 + source.below(9)) + source.like(entity[1:])
        if _luhn(entity) == 0:  # a valid number stays valid
            digits = digits[:-1] + next(d for d in "0123456789" if _luhn(digits[:-1] + d) == 0)
        return digits
    if kind == "iban":
        body = source.like(entity[4:])
        number = "".join(str(int(c, 36)) for c in body + entity[:2] + "00")
        return f"{entity[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "name":
        gender, names = entity[0], entity[2:].split(" ")
        script = "cyrillic" if re.search("[а-яё]", entity) else "latin"
        drawn = "mf"[source.below(2)] if gender == "n" else gender
        family = FAMILY.get(f"{script} {drawn}", FAMILY.get(script))
        given = GIVEN[f"{script} {drawn}"]
        parts = [family[source.below(len(family))]] if len(names) == 1 else [given[source.below(len(given))], family[source.below(len(family))]]
        if attempt > 2:  # the lists may be exhausted: made-up syllables have no end
            parts[-1] = "".join(SYLLABLES[script][source.below(12)] for _ in range(2 + attempt // 2)).capitalize()
        return gender + " " + " ".join(parts).casefold()
    if kind == "access":
        return entity[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[source.below(36)] for _ in entity[4:])
    if kind == "block":
        head, body, tail = re.match(r"(-----BEGIN [^-]*-----)([\s\S]*)(-----END [^-]*-----)", entity).groups()
        return head + source.like(body) + tail
    start = re.match(r"[\"']?(?:gh[pousr]_|sk-)?", entity)[0]
    body = entity[len(start):]
    return start + source.like(body, hexadecimal=bool(re.fullmatch(r"[0-9a-fA-F]+", body)))


def _cased(word: str, like: str) -> str:
    return word.upper() if len(like) > 1 and like.isupper() else word[:1].upper() + word[1:]


def render(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the mention's spelling: its punctuation, case and title."""
    if surrogate.startswith(f"[{kind} "):
        return surrogate
    if kind in ("phone", "card", "ssn"):
        digits = iter(surrogate)
        return re.sub(r"\d", lambda _: next(digits), mention)
    if kind in ("email", "ip6"):
        return surrogate.upper() if mention.isupper() else surrogate
    if kind == "iban":
        rest = iter(surrogate)
        return "".join(c if c == " " else next(rest) for c in mention)
    if kind == "name":
        title, _, names = split_name(mention)
        return title + " ".join(_cased(w, like) for w, like in zip(surrogate[2:].split(" "), names))
    return surrogate


def replace(text: str | None, key: bytes, attempts: dict[tuple[str, str], int] | None = None) -> tuple[str | None, int]:
    """(text with surrogates, number of mentions)."""
    out, at, n = [], 0, 0
    for start, end, kind, entity in mentions(text):
        surrogate = surrogate_entity(key, kind, entity, (attempts or {}).get((kind, entity), 0))
        out += [text[at:start], render(kind, text[start:end], surrogate)]
        at, n = end, n + 1
    return (text, 0) if not n else ("".join(out) + text[at:], n)


def entities(docs: DataFrame) -> DataFrame:
    """(__pw_hash, kind, entity): the distinct entities of each text."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(h, kind, entity) for h, text in zip(batch["__pw_hash"], batch["text"])
                    for kind, entity in dict.fromkeys((k, e) for _, _, k, e in mentions(text))]
            yield pd.DataFrame(rows, columns=["__pw_hash", "kind", "entity"])

    mine = docs.filter("text is not null").select(F.xxhash64("text").alias("__pw_hash"), "text")
    return mine.mapInPandas(find, "__pw_hash long, kind string, entity string")


def clashes(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt) of the entities that do not keep their first draw.

    In each round every open entity draws.  A draw that is an original, or is
    already taken, is void; of several equal ones the smallest entity keeps it.
    Rounds end when no entity is open; they see fewer rows each time, and from
    ``LAST_DRAW`` on draws no longer depend on what a format can hold.
    """

    @F.pandas_udf(T.StringType())
    def draw(kinds: pd.Series, names: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([surrogate_entity(key, k, e, int(a)) for k, e, a in zip(kinds, names, attempts)], dtype=object)

    every = materialise(found.select("kind", "entity").distinct())
    originals = every.select("kind", F.col("entity").alias("drawn"))
    open_, taken, late, attempt = every, None, None, 0
    while True:
        drawn = materialise(open_.withColumn("drawn", draw("kind", "entity", F.lit(attempt))))
        free = drawn.join(originals, ["kind", "drawn"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "drawn"], "left_anti")
        winners = materialise(free.groupBy("kind", "drawn").agg(F.min("entity").alias("entity")))
        won = winners.select("kind", "entity").withColumn("attempt", F.lit(attempt))
        if attempt:
            late = won if late is None else late.unionByName(won)
        open_ = materialise(drawn.join(won, ["kind", "entity"], "left_anti").select("kind", "entity"))
        if open_.isEmpty():
            break
        taken = winners.select("kind", "drawn") if taken is None else taken.unionByName(winners.select("kind", "drawn"))
        attempt += 1
    if late is None:
        return every.limit(0).withColumn("attempt", F.lit(0))
    return materialise(late)


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text`` and the column n_surrogates (in place of
    any such column).

    An entity has the same surrogate in all rows, and different entities have
    different ones.  Entities that drew again are joined to their texts by a hash
    of the text; that table holds clashes only, and Spark broadcasts or shuffles
    it by its size.  NULL and empty texts stay as they are with 0; repeated rows
    stay alike.
    """
    mine = docs.drop("n_surrogates").withColumnRenamed(text, "__pw_text") if text == "text" else docs.drop("n_surrogates").withColumn("__pw_text", F.col(text)).drop(text)
    found = materialise(entities(mine.select(F.col("__pw_text").alias("text"))))
    late = clashes(found, key)
    again = materialise(found.join(late, ["kind", "entity"]).groupBy("__pw_hash").agg(
        F.collect_set(F.struct("kind", "entity", "attempt")).alias("__pw_again")))  # a text's own entities only
    result = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])

    @F.pandas_udf(result)
    def replaced(texts: pd.Series, agains: pd.Series) -> pd.DataFrame:
        rows = [replace(t, key, None if a is None else {(x["kind"], x["entity"]): x["attempt"] for x in a}) for t, a in zip(texts, agains)]
        return pd.DataFrame(rows, columns=["text", "n"])

    joined = mine.join(again, F.xxhash64("__pw_text") == F.col("__pw_hash"), "left")
    done = joined.withColumn("__pw_new", replaced("__pw_text", "__pw_again"))
    columns = [F.col("__pw_new.text").alias(text) if c == text else F.col(c) for c in docs.columns if c != "n_surrogates"]
    return done.select(*columns, F.col("__pw_new.n").alias("n_surrogates"))
