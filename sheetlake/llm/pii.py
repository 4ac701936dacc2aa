"""Personal data replaced by keyed surrogates (DataFrame functions only).

One pattern finds e-mail addresses, phone numbers, IP addresses, payment
cards, social security numbers, bank accounts, access keys, assigned secrets
and titled names. Every distinct value gets one surrogate from a keyed hash,
of the same type and format: separators, lengths and letter classes stay, card
check digits stay valid, names keep title, gender and script. The same value
has the same surrogate in all documents. Surrogates are checked against each
other and against all original values; a clash moves the later value to its
next attempt until none is left, so distinct values stay distinct. Family names
settle first, and a family keeps its surrogate whatever its members' are.

A text is rebuilt from its parts between the matches and the replacements in
order. Texts without a match never shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetlake.llm.common import narrow, written

KEY = "change-me"
MAX_ATTEMPTS = 30

# Titles by gender, as written before a name.
TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "г-н"],
          "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "г-жа"]}
# Given names and name syllables for surrogates, by gender and script.
GIVEN = {
    "m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo",
          "Ivan", "Jonas", "Karl", "Leon", "Marco", "Nico", "Oscar", "Paul"],
    "f": ["Anna", "Berta", "Clara", "Dora", "Emma", "Flora", "Greta", "Helena",
          "Irma", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"],
    "cm": ["Антон", "Борис", "Вадим", "Глеб", "Денис", "Егор", "Захар", "Иван",
           "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Семён"],
    "cf": ["Анна", "Белла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя",
           "Инна", "Клара", "Лидия", "Мария", "Нина", "Ольга", "Раиса", "Софья"],
}
SYLLABLES = {
    "l": ["ba", "de", "fi", "go", "hu", "ka", "le", "mi", "no", "pu", "ra", "se", "ti", "vo", "wu", "za"],
    "c": ["ба", "де", "фи", "го", "ху", "ка", "ле", "ми", "но", "пу", "ра", "се", "ти", "во", "жу", "за"],
}

_START, _END = r"(?<![\p{L}\p{N}._%+\-])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TITLE = "(?:" + "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True)) + r")\.?"
_SECRET = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)+",
    "key": r"AKIA[0-9A-Z]{16}" + _END,
    "secret": _SECRET + r"(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{8,}+",
    "name": _TITLE + r" \p{Lu}\p{L}++(?: \p{Lu}\p{L}++)?",
    "ip": r"(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![0-9]|\.[0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END,
    "card": r"(?:[0-9]{4}[ \-]?){3}[0-9]{4}" + _END + r"|[0-9]{13,19}" + _END,
    "iban": r"[A-Z]{2}[0-9]{2}(?=[A-Z0-9]*[0-9]{6})[A-Z0-9]{11,30}" + _END,
    "phone": r"(?:\+[0-9]{1,3}[ .\-]?)?\([0-9]{2,4}\)[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,4}" + _END
             + r"|\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){2,5}" + _END + r"|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}" + _END,
}
PATTERN = _START + "(?:" + "|".join(PATTERNS.values()) + ")"


def kind_of(match: Column) -> Column:
    """The type of a matched string."""
    chain = F.when(match.contains("@"), "email")
    for kind in ("key", "name", "secret", "ip", "ssn", "card", "iban"):
        chain = chain.when(match.rlike("^(?:" + PATTERNS[kind] + ")$"), kind)
    return chain.otherwise("phone")


def prefix_of(kind: Column, match: Column) -> Column:
    """What stays as it is before the value: a secret's name, a person's title."""
    return (F.when(kind == "secret", F.regexp_extract(match, "^(" + _SECRET + ")", 1))
            .when(kind == "name", F.regexp_extract(match, "^(" + _TITLE + " )", 1)).otherwise(""))


def _hex(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts).cast("binary"), 256)


def _reshaped(value: Column, stream: Column) -> Column:
    """Each digit, capital and small letter replaced by one of its class, from
    a stream of hexadecimal digits; everything else stays. Hexadecimal values
    stay hexadecimal."""
    digits = F.translate(stream, "abcdef", "273849")
    small = F.when(value.rlike("^[0-9a-f]+$"), F.translate(stream, "0123456789", "abcdefabcd")).otherwise(
        F.translate(stream, "0123456789", "ghijklmnop"))
    characters = F.filter(F.split(value, ""), lambda c: c != "")

    def one(c: Column, i: Column) -> Column:
        at = F.pmod(i, F.lit(64)).cast("int") + 1
        return (F.when(c.rlike("^[0-9]$"), digits.substr(at, F.lit(1)))
                .when(c.rlike("^[a-z]$"), small.substr(at, F.lit(1)))
                .when(c.rlike("^[A-Z]$"), F.upper(small.substr(at, F.lit(1)))).otherwise(c))
    return F.array_join(F.transform(characters, one), "")


def _byte(stream: Column, k: int) -> Column:
    return F.conv(stream.substr(2 * k + 1, 2), 16, 10).cast("int")


def _nibble(stream: Column, k: int) -> Column:
    return F.conv(stream.substr(k + 1, 1), 16, 10).cast("int")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, doubling every second from the right, the last one not."""
    back = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    folded = F.transform(back, lambda d, i: F.when(i % 2 == 0, d).otherwise(
        F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return F.aggregate(folded, F.lit(0), lambda a, b: a + b)


def _card(value: Column, stream: Column) -> Column:
    """Same length, separators and first digit; a valid check digit stays valid."""
    mixed = F.concat(value.substr(1, 1), _reshaped(value.substr(F.lit(2), F.length(value)), stream))
    digits = F.regexp_replace(mixed, "[^0-9]", "")
    body = digits.substr(F.lit(1), F.length(digits) - 1)
    check = F.pmod(10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    valid = _luhn_sum(F.regexp_replace(value, "[^0-9]", "")) % 10 == 0
    return F.when(valid, F.concat(mixed.substr(F.lit(1), F.length(mixed) - 1), check)).otherwise(mixed)


def _pick(names: list[str], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), at + 1)


def _syllables(value: Column, stream: Column, count: Column) -> Column:
    """``count`` syllables in the value's script, at most 60."""
    def joined(script: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), F.least(count, F.lit(60))), lambda i: _pick(
            SYLLABLES[script], F.conv(stream.substr(i, F.lit(1)), 16, 10).cast("int"))), "")
    return F.when(value.rlike(r"\p{IsCyrillic}"), joined("c")).otherwise(joined("l"))


def family_name(key: str, family: Column, attempt: Column) -> Column:
    """A family name's surrogate, from syllables."""
    return F.initcap(_syllables(family, _hex(key, F.lit("family"), family, attempt.cast("string")), 4 + attempt))


def given_name(key: str, name: Column, gender: Column, attempt: Column) -> Column:
    """The surrogate of a person's given name, by gender and script. Given names
    are few, so the later of two that meet in one family gets syllables added."""
    given = F.substring_index(name, " ", 1)
    cyrillic = name.rlike(r"\p{IsCyrillic}")
    h = _hex(key, F.lit("given"), given)
    g = _nibble(h, 0)
    first = F.when(cyrillic & (gender == "f"), _pick(GIVEN["cf"], g)).when(cyrillic, _pick(GIVEN["cm"], g)).when(
        gender == "f", _pick(GIVEN["f"], g)).otherwise(_pick(GIVEN["m"], g))
    more = _syllables(name, _hex(key, F.lit("given"), given, attempt.cast("string")), 1 + attempt)
    return F.concat(first, F.when(attempt > 0, more).otherwise(""))


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """A value's replacement of the same kind and format (of all kinds but
    names). Spellings of an address in capitals or not draw the same letters."""
    stream = _hex(key, kind, F.when(kind == "email", F.lower(value)).otherwise(value), attempt.cast("string"))
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    email = F.concat(_reshaped(local, stream), F.when(attempt > 0, stream.substr(1, 8)).otherwise(""), F.lit("@"),
                     F.lit("h"), _hex(key, F.lit("domain"), F.lower(domain)).substr(1, 10), F.lit(".example.net"))
    ip = F.concat_ws(".", 1 + _byte(stream, 0) % 223, _byte(stream, 1), _byte(stream, 2), 1 + _byte(stream, 3) % 254)
    country = F.regexp_extract(value, r"^(\+[0-9]{1,3}(?=[ .\-(])|\+[0-9])", 1)
    phone = F.concat(country, _reshaped(value.substr(F.length(country) + 1, F.length(value)), stream))
    fixed = F.when(kind == "key", 4).when(kind == "iban", 2).otherwise(0)
    other = F.concat(value.substr(F.lit(1), fixed), _reshaped(value.substr(fixed + 1, F.length(value)), stream))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone)
            .when(kind == "card", _card(value, stream))
            .otherwise(other))


def _decomposed(match: Column) -> tuple[Column, Column, Column]:
    kind = kind_of(match)
    prefix = prefix_of(kind, match)
    value = match.substr(F.length(prefix) + 1, F.length(match))
    female = prefix.rlike("^(?:" + "|".join(TITLES["f"]) + r")\.? $")
    return (F.when(kind == "name", F.when(female, "name-f").otherwise("name-m")).otherwise(kind), prefix, value)


def _settled(values: DataFrame, draw: Callable[[], Column], kinds: Column) -> DataFrame:
    """``values`` (kind, value and what ``draw`` needs) plus ``surrogate``,
    drawn from the columns and ``attempt`` until no two values of one of
    ``kinds`` share a surrogate and none is an original value."""
    names = values.columns
    table = written(values.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw()), "pii-surrogates")
    # men and women of one name are one value: the value counts, not the kind
    earlier = Window.partitionBy(kinds, "surrogate").orderBy("attempt", "value")
    for _ in range(MAX_ATTEMPTS):
        taken = table.select(kinds.alias("f"), F.col("value").alias("original")).distinct()
        checked = (table.withColumn("rank", F.dense_rank().over(earlier))
                   .join(taken, (kinds == F.col("f")) & (F.col("surrogate") == F.col("original")), "left")
                   .withColumn("clash", (F.col("rank") > 1) | F.col("original").isNotNull()))
        checked = written(checked.select(*names, "attempt", "surrogate", "clash"), "pii-checked")
        if not checked.filter("clash").take(1):
            return table.select(*names, "surrogate")
        again = checked.filter("clash").select(*names, (F.col("attempt") + 1).alias("attempt"))
        again = written(again.withColumn("surrogate", draw()), "pii-surrogates")
        table = checked.filter("not clash").drop("clash").union(again)
    raise RuntimeError("surrogates still clash")


def surrogates(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value), without clashes:
    no two values of a kind share a surrogate and none is an original value.

    Family names settle first, in a table of their own; a person's surrogate
    is a given name before the family's. Where two persons of a family clash,
    only the given name is drawn again, so all of a family, and the family
    name alone, keep one surrogate.
    """
    values = written(values.select("kind", "value"), "pii-values")
    kind, value, attempt = F.col("kind"), F.col("value"), F.col("attempt")
    is_name = kind.startswith("name")
    out = _settled(values.filter(~is_name), lambda: surrogate(key, kind, value, attempt), kind)
    names = values.filter(is_name).withColumn("last", F.substring_index("value", " ", -1))
    if not names.take(1):
        return out
    families = _settled(names.select(F.lit("family").alias("kind"), F.col("last").alias("value")).distinct(),
                        lambda: family_name(key, value, attempt), kind)
    names = names.join(families.select(F.col("value").alias("last"), F.col("surrogate").alias("family")), "last")
    alone = names.filter(value == F.col("last")).select("kind", "value", F.col("family").alias("surrogate"))
    persons = _settled(names.filter(value != F.col("last")).select("kind", "value", "family"),
                       lambda: F.concat_ws(" ", given_name(key, value, F.substring_index(kind, "-", -1), attempt), "family"),
                       F.substring_index(kind, "-", 1))
    return out.unionByName(alone).unionByName(persons.select("kind", "value", "surrogate"))


def _replaced(docs: DataFrame, text_col: str, key: str) -> DataFrame:
    """(row, text, n_entities): every row as a struct, its new text and count."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs[text_col].cast("string").alias("text"))
    found = F.col("text").rlike(PATTERN)
    clean = rows.filter(~F.coalesce(found, F.lit(False))).select("row", "text", F.lit(0).alias("n_entities"))
    dirty = written(rows.filter(found).select(
        "row", "text", F.xxhash64("text").alias("h"), F.md5(F.col("text").cast("binary")).alias("digest"),
        F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("matches")), "pii-rows", "zstd")
    texts = dirty.groupBy("digest", "h").agg(F.first("matches").alias("matches"))
    kind, prefix, value = _decomposed(F.col("match"))
    entities = written(
        texts.select("digest", "h", F.posexplode("matches").alias("pos", "match"))
        .select("digest", "h", "pos", kind.alias("kind"), prefix.alias("prefix"), value.alias("value")),
        "pii-entities")
    chosen = surrogates(entities.select("kind", "value").distinct(), key)
    new = (entities.join(chosen, ["kind", "value"])
           .groupBy("digest", "h").agg(F.array_sort(F.collect_list(F.struct(
               "pos", F.concat("prefix", "surrogate").alias("new")))).alias("news")))
    between = F.split("text", PATTERN, -1)
    rebuilt = F.array_join(F.concat(
        F.flatten(F.zip_with(F.slice(between, F.lit(1), F.size("news")), F.col("news.new"), lambda a, b: F.array(a, b))),
        F.array(F.element_at(between, -1))), "")
    changed = dirty.drop("matches").join(new, ["digest", "h"]).select(
        "row", rebuilt.alias("text"), F.size("news").alias("n_entities"))
    return clean.union(changed)


def replace_personal_data(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with every detected value in ``text_col`` replaced; all other
    columns, null texts and texts without a value are unchanged. Rows repeat
    as in the input; nothing depends on ids; texts of any length are rewritten
    whole. Columns may have any name; an empty table stays empty."""
    new = _replaced(docs, text_col, key)
    return new.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def anonymised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY) -> DataFrame:
    """doc_id, text (with surrogates; null stays null) and n_entities for every row."""
    new = _replaced(narrow(docs, doc_id=id_col, text=text_col), "text", key)
    return new.select(F.col("row.doc_id").alias("doc_id"), "text", F.col("n_entities").cast("long").alias("n_entities"))
