"""Operator 2, surrogate generation for personal data; DataFrame functions only.

One pattern finds entities: e-mail addresses, card, phone, social-security and account numbers, IP
addresses, access tokens, and parts of personal names (after a title or a common given name; hyphens and
apostrophes belong to a name).  A card number must have a valid check digit; book numbers (978, 979) are none.
In a text with names, every capitalised word that is a part of a name found in it is a mention too, so "Later
Smith left and John stayed" follows "Mr. John Smith".  Each distinct entity (type and normalised form: digits of numbers, lower case of the rest) gets one
replacement for the whole table, drawn by a keyed hash, so all mentions of an entity stay together in
whatever spelling.  Replacements keep the type and the format: separators, lengths, letter case,
script, top-level domain, country digit and a valid card check digit; given names keep gender and
script.

Collision checks: a replacement must differ from every other entity's replacement and from every real
entity of its type.  Entities that fail draw again with the next attempt number until none fails;
earlier draws keep their place.  Each check is a join and an aggregation of the entity table, and one
number reaches the driver.

Only rows with an entity have their matches exploded; texts meet their replacements in one join by
row number.  Rows are numbered once, in a staged copy of the table that all later reads use.

Edge cases: null texts stay null and empty texts empty; texts without entities pass unchanged;
repeated rows get the same replacements; empty tables give empty results.  Texts of any length are
searched whole: repetitions in the patterns are either of single characters, which need no stack, or bounded
(a local part up to 64 characters, labels of up to 63 in a domain, as mail rules have it; 41 letters in a part of a name).  ``n_chars``, where the
table has it, follows the new text; other columns and their names are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import free_name, stage

# Titles, and common given names by gender and script, which are also what
# replacements of given names are first drawn from.
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Señor", "Señora", "Sr", "Sra", "Monsieur", "Madame", "Mme",
          "господин", "госпожа"]
GIVEN = {
    ("f", "latin"): ["Anna", "Maria", "Laura", "Julia", "Sarah", "Emma", "Sophie", "Claire", "Elena", "Carmen", "Lucia", "Ingrid",
                     "Mary", "Jane", "Alice", "Susan", "Linda", "Karen", "Monika", "Petra", "Camille", "Isabel", "Marta", "Greta"],
    ("m", "latin"): ["John", "James", "Robert", "Michael", "David", "Thomas", "Peter", "Paul", "Hans", "Klaus", "Jean", "Pierre",
                     "Luis", "Carlos", "Miguel", "Pablo", "Henri", "Louis", "Walter", "Stefan", "Mark", "Daniel", "Jorge", "Simon"],
    ("f", "cyrillic"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Светлана"],
    ("m", "cyrillic"): ["Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей", "Михаил"],
}
SYLLABLES = {"latin": ["ba", "de", "li", "mo", "ra", "se", "ti", "no", "ka", "ve", "lo", "ma", "ri", "ne", "sa", "do"],
             "cyrillic": ["ба", "де", "ли", "мо", "ра", "се", "ти", "но", "ка", "ве", "ло", "ма", "ри", "не", "са", "до"]}
#: Attempts after which a type's forms count as exhausted.
ATTEMPTS = 60

_ALL_GIVEN = [n for names in GIVEN.values() for n in names]
_TITLE = r"(?:" + "|".join(TITLES) + r")\.? "
_FIRST = r"(?:" + "|".join(_ALL_GIVEN) + r")(?:-\p{Lu}\p{L}{1,30})?"
#: What follows the capital of a name: "mith", "'Neill", "l-Hassan"; parts of at most 41 letters.
_REST = r"(?:['’]\p{Lu})?\p{L}{1,40}(?:[-'’]\p{Lu}\p{L}{1,40}){0,3}(?!\p{L})"

PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,10}\.[A-Za-z]{2,63}",
    "token": r"\b(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![0-9.vV])(?<![vV][ .])(?<!ersion )(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}"
          r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9+-])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{4,5}"
            r"|[0-9]{4}-[0-9]{6}-[0-9]{4,5}|[0-9](?: [0-9]){12,18}|[0-9](?:-[0-9]){12,18})(?![0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
             r"|(?<![0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "given": r"\b" + _FIRST + r"(?= \p{Lu}(?:\p{L}|['’]\p{Lu}))",
    "surname": r"\p{Lu}(?<=\b" + _FIRST + r" \p{Lu})" + _REST +
               r"|\p{Lu}(?<=\b" + _TITLE + r"(?:\p{Lu}\p{L}{1,30} )?\p{Lu})" + _REST,
}
#: A capitalised word that may repeat a part of a name; it ends before what another pattern finds.
BARE = (r"(?<![\p{L}\p{N}])\p{Lu}(?:['’]\p{Lu})?\p{L}{1,40}"
        r"(?:[-'’](?!AKIA|[0-9A-F]{32})\p{Lu}\p{L}{1,40}){0,3}(?![\p{L}\p{N}])")
PATTERN = "|".join(PATTERNS.values())
WITH_BARE = PATTERN + "|" + BARE
_LED = [*TITLES, *_ALL_GIVEN]
#: What every match needs somewhere in the text, by pattern: email; token; iban, ip, card, phone and ssn (two digits
#: with at most one separator between); given and surname.  Texts without it are not searched.
HINT = (r"@|[0-9][ .-]?[0-9]|[0-9a-fA-F]{32}|AKIA|gh[opsu]_|sk-"
        r"|(?=[" + "".join(sorted({n[0] for n in _LED})) + r"])(?:" + "|".join(_LED) + r")(?:-\p{Lu}\p{L}{1,30})?\.? \p{Lu}")
NAMES = ["given_f", "given_m", "surname"]


def _type_of(match: Column) -> Column:
    digits, name = F.length(F.regexp_replace(match, "[^0-9]", "")), F.lower(F.substring_index(match, "-", 1))
    return (F.when(match.contains("@"), "email")
            .when(match.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"), "hex")
            .when(match.rlike(r"^(?:AKIA|gh[opsu]_|sk-)"), "token")
            .when(match.rlike(r"^[A-Z]{2}[0-9]{2}"), "iban")
            .when(match.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip")
            .when(match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(match.rlike(r"^[0-9]") & (digits >= 13), "card")
            .when(match.rlike(r"^[+(0-9]"), "phone")
            .when(name.isin([n.lower() for n in GIVEN["f", "latin"] + GIVEN["f", "cyrillic"]]), "given_f")
            .when(name.isin([n.lower() for n in GIVEN["m", "latin"] + GIVEN["m", "cyrillic"]]), "given_m")
            .otherwise("surname"))


def _key_of(kind: Column, match: Column) -> Column:
    """The normalised form: what two mentions of one entity have in common."""
    return (F.when(kind.isin("card", "ssn"), F.regexp_replace(match, "[^0-9]", ""))
            .when(kind == "phone", F.regexp_replace(match, "[^0-9+]", ""))
            .when(kind == "iban", F.regexp_replace(match, " ", ""))
            .when(kind == "token", match).otherwise(F.lower(match)))


def _draw(key: str, size: int, *parts: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(key), *parts), F.lit(size)).cast("int")


def _pick(options: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), at + 1)


def _shaped(key: str) -> Column:
    """Letters for letters and digits for digits, character by character."""
    lower, upper, greek, cyrillic = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщыэюя"
    kind, form = F.col("kind"), F.col("key")

    def one(c: Column, i: Column) -> Column:
        def among(letters: str) -> Column:
            return F.substring(F.lit(letters), _draw(key, len(letters), kind, form, F.col("attempt"), i) + 1, F.lit(1))

        country = (kind == "phone") & (i == 1) & form.startswith("+")
        iban = (kind == "iban") & (i < 2)
        top = (kind == "email") & (i >= F.length(form) - F.length(F.substring_index(form, ".", -1)))
        return (F.when(country | iban | top | ~c.rlike(r"[\p{L}\p{N}]"), c)
                .when(kind == "hex", among("0123456789abcdef"))
                .when(c.rlike("[0-9]"), among("0123456789")).when(c.rlike("[A-Z]"), among(upper))
                .when(c.rlike(r"\p{IsCyrillic}"), among(cyrillic)).when(c.rlike(r"\p{IsGreek}"), among(greek))
                .otherwise(among(lower)))

    prefix = F.when(kind == "token", F.regexp_extract("key", r"^(?:AKIA|gh[opsu]_|sk-)", 0)).otherwise(F.lit(""))
    shaped = F.array_join(F.transform(F.split("key", ""), one), "")
    return F.concat(prefix, F.substring(shaped, F.length(prefix) + 1, F.length(shaped)))


def _luhn(digits: Column) -> Column:
    """Check sum of a digit string modulo 10, the last digit included."""
    def double(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), double), F.lit(0), lambda a, x: a + x) % 10


def _surrogate(key: str) -> Column:
    """Replacement of (kind, key) at this attempt, in normalised form."""
    kind, form, attempt = F.col("kind"), F.col("key"), F.col("attempt")
    shaped = _shaped(key)
    body = F.substring(shaped, F.lit(1), F.length(shaped) - 1)
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    ip = F.concat_ws(".", *(1 + _draw(key, 254, kind, form, attempt, F.lit(k)) for k in range(4)))
    script = F.when(form.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def spoken(name: str) -> Column:
        count = 2 + F.floor(attempt / 3).cast("int") + _draw(key, 2, kind, form, F.lit("n"))
        return F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: _pick(SYLLABLES[name], _draw(key, 16, kind, form, attempt, i))), "")

    generated = F.when(script == "cyrillic", spoken("cyrillic")).otherwise(spoken("latin"))
    double = F.concat(generated, F.lit("-"), F.reverse(generated))  # a double name stays one

    def given(gender: str) -> Column:
        chosen = F.when(script == "cyrillic", _pick(GIVEN[gender, "cyrillic"], _draw(key, 8, kind, form, attempt))) \
            .otherwise(_pick(GIVEN[gender, "latin"], _draw(key, 24, kind, form, attempt)))
        # A gender's ending marks generated names once the common names are taken.
        ending = F.when(script == "cyrillic", {"f": "на", "m": "н"}[gender]).otherwise({"f": "a", "m": "n"}[gender])
        return F.when(attempt < 6, F.lower(chosen)).otherwise(F.concat(generated, ending))

    return (F.when(kind == "ip", ip).when(kind == "given_f", given("f")).when(kind == "given_m", given("m"))
            .when(kind == "surname", F.when(form.contains("-"), double).otherwise(generated))
            .when((kind == "card") & (_luhn(form) == 0), F.concat(body, check)).otherwise(shaped))


def _in_format_of(match: Column, kind: Column, surrogate: Column) -> Column:
    """The normalised replacement with the separators and the letter case of the mention."""
    def place(i: Column) -> Column:
        c, upto = F.substring(match, i, F.lit(1)), F.substring(match, F.lit(1), i)
        rank = F.length(F.when(kind.isin("card", "ssn"), F.regexp_replace(upto, "[^0-9]", ""))
                        .when(kind == "phone", F.regexp_replace(upto, "[^0-9+]", "")).otherwise(F.regexp_replace(upto, " ", "")))
        return F.when(c.rlike("[A-Z0-9+]"), F.substring(surrogate, rank, F.lit(1))).otherwise(c)

    spaced = F.array_join(F.transform(F.sequence(F.lit(1), F.length(match)), place), "")
    cased = (F.when((F.upper(match) == match) & (F.lower(match) != match), F.upper(surrogate))
             .when(kind.isin(*NAMES), F.array_join(F.transform(F.split(surrogate, "-"), F.initcap), "-")).otherwise(surrogate))
    return F.when(kind.isin("card", "ssn", "phone", "iban"), spaced).when(kind == "token", surrogate).otherwise(cased)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, key, surrogate) of distinct entities (kind, key), without collisions."""
    table = stage(entities.select("kind", "key").distinct().withColumn("attempt", F.lit(0)).withColumn("s", _surrogate(key)), "pii-drawn")
    for _ in range(ATTEMPTS):
        first = table.groupBy("kind", "s").agg(F.min(F.struct("attempt", "key")).alias("first"))
        real = table.select("kind", F.col("key").alias("s"), F.lit(True).alias("real"))
        judged = (table.join(first, ["kind", "s"]).join(real, ["kind", "s"], "left")
                  .withColumn("bad", F.coalesce("real", F.lit(False)) | (F.col("key") != F.col("first.key"))))
        judged = stage(judged.select("kind", "key", "attempt", "s", "bad"), "pii-judged")
        if judged.where("bad").isEmpty():
            return judged.select("kind", "key", F.col("s").alias("surrogate"))
        again = judged.where("bad").select("kind", "key", (F.col("attempt") + 1).alias("attempt")).withColumn("s", _surrogate(key))
        table = stage(judged.where("not bad").select("kind", "key", "attempt", "s").unionByName(again), "pii-drawn")
    raise ValueError("an entity type has more distinct entities than forms")


def replace(docs: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with surrogates in the text, and the name of the added column with the number of replaced mentions."""
    count, row = free_name(docs.columns, "n_entities"), free_name(docs.columns, "_pii_row")
    source, kind, form = F.col(text), F.col("kind"), F.col("key")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "pii-rows")
    found = (rows.select(F.col(row).alias("row"), source.alias("t")).where(F.col("t").rlike(HINT))
             .withColumn("matches", F.regexp_extract_all("t", F.lit(PATTERN), 0)).where(F.size("matches") > 0))
    names = F.transform(F.filter("matches", lambda m: _type_of(m).isin(*NAMES)), F.lower)
    # Texts with names are searched again, for bare mentions of their parts.
    found = found.withColumn("names", F.array_distinct(names)).select(
        "row", "names", F.when(F.size("names") == 0, F.col("matches")).otherwise(F.regexp_extract_all("t", F.lit(WITH_BARE), 0)).alias("matches"))
    found = stage(found, "pii-found")
    matched = (found.select("row", (F.size("names") > 0).alias("bare"), F.posexplode("matches").alias("place", "mention"))
               .withColumn("kind", _type_of(F.col("mention"))).withColumn("key", _key_of(kind, F.col("mention"))))
    parts = found.select("row", F.explode("names").alias("key"), F.lit(True).alias("part"))
    # A match of a name counts if it is a part of a name of its text, a card if its digits check.
    card = (_luhn(form) == 0) & ~((F.length(form) == 13) & form.rlike("^97[89]"))
    counts = F.when(kind.isin(*NAMES), F.col("part").isNotNull()).when(kind == "card", card).otherwise(F.lit(True))
    mentions = stage(matched.join(parts, ["row", "key"], "left").withColumn("real", counts).drop("part"), "pii-mentions")
    drawn = surrogates(mentions.where("real").select("kind", "key"), key)
    put = F.when(F.col("real"), _in_format_of(F.col("mention"), kind, F.col("surrogate"))).otherwise(F.col("mention"))
    per_row = (mentions.join(drawn, ["kind", "key"], "left").select("row", "bare", "real", F.struct("place", put.alias("put")).alias("one"))
               .groupBy("row").agg(F.sort_array(F.collect_list("one")).alias("puts"), F.count_if("real").alias("n"), F.any_value("bare").alias("bare"))
               .where("n > 0"))
    put_names = [f"{row}puts", f"{row}n", f"{row}bare"]
    per_row = per_row.select(F.col("row").alias(row), F.transform("puts", lambda p: p["put"]).alias(put_names[0]),
                             F.col("n").alias(put_names[1]), F.col("bare").alias(put_names[2]))
    puts, n, bare = map(F.col, put_names)

    def rebuilt(pattern: str) -> Column:
        filled = F.concat(puts, F.array(F.lit("")))
        return F.array_join(F.zip_with(F.split(source, pattern, -1), filled, lambda gap, put: F.concat(gap, put)), "")

    out = (rows.join(per_row, row, "left")
           .withColumn(text, F.when(puts.isNull(), source).when(bare, rebuilt(WITH_BARE)).otherwise(rebuilt(PATTERN)))
           .withColumn(count, F.coalesce(n, F.lit(0)).cast("long")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(puts.isNull(), F.col("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns, count), count


def digest(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, the text with surrogates, the number of replaced mentions."""
    out, count = replace(docs.select("doc_id", "text"), key)
    return out.select("doc_id", "text", F.col(count).alias("n_entities"))
