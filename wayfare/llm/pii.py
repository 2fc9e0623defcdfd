"""Personal data and secrets replaced by surrogates, with Spark expressions only.

Found are mail addresses, telephone, card, bank and social security numbers, network addresses, access keys, tokens and
passwords, and names behind a title. Each gets a surrogate made from a secret key, its kind and its normal form:
digits give digits, letters give letters of the same case, so script, length and punctuation stay; network addresses
stay valid, card and bank numbers get right check digits; a name gets syllables of its script, a first name with the
ending of the gender its title tells.

Coreference: the surrogate depends on the normal form alone (digits of numbers, lower case of addresses), so all
mentions in all documents agree. Each word of a name has a surrogate of its own, and the words of the names that a
document has behind titles are replaced wherever else they stand in it as whole words: ``Mr. John Smith``,
``John Smith``, ``Mrs. Smith`` and ``Smith`` share theirs. A first name that has titles of both genders is taken, where
it stands without one, for that of a woman. Distinctness: all normal forms of the table are checked. Where two share a
surrogate, or a surrogate is itself a normal form of the table, all but the first are made anew with a higher attempt,
until none clash. Only attempts above the first have to be looked up, by a join whose side is usually empty.

Defined results: a null text stays null; a text without findings is returned unchanged, whichever its white space;
repeated rows get equal texts; rows without an id are handled like others; texts of any length are searched whole. Other
columns pass untouched, whatever their names; ``count_col`` must not be one of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.running import kept

# How the kinds look. Order matters where one could be part of another. A long look behind comes after
# a short one that most places fail.
MALE, FEMALE = "Mr|Herr|Señor|Monsieur|господин|Господин", "Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mademoiselle|госпожа|Госпожа"
#: a word of a name; it ends before the s of a genitive
NAME_WORD = r"\p{Lu}(?:\p{L}|['-](?=\p{L}{2}))+"
PATTERNS = {
    "mail": r"(?<![\w.+-])[\w.+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}\b",
    "token": r"(?<=[=: \"'])(?=[A-Za-z0-9_\-]{16})(?i:(?<=\b(?:token|secret|api_key|apikey)\b ?[=:] ?[\"']?))[A-Za-z0-9_\-]+",
    "password": r"(?<=[=:] ?)(?i:(?<=\b(?:password|passwd|pwd)[=:] ?))\S+",
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "bank": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "address": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "address6": r"(?<![\w:.])(?=[23][0-9A-Fa-f]{3}:|[Ff][CcDdEe][0-9A-Fa-f]{2}:)(?=[A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])",
    "card": r"(?<![\w.-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)"
    r"|(?<![\w+.-])(?:[2-9]\d{2} [2-9]\d{2} \d{4}|[2-9]\d{2}[2-9]\d{6}|0\d{2,4} \d{3,4} \d{3,4})(?![\w-])",
    "social": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "name": rf"(?=\p{{Lu}})(?<=[ .])(?<=\b(?:{MALE}|{FEMALE})\.? ){NAME_WORD}(?: {NAME_WORD})?",
}
#: Every pattern needs a digit, an at sign, one of these as they are, or one of the others in any case: a text without
#: any has no findings, and is not searched.
HINTS = ("Mr", "Ms", "Miss", "Herr", "Frau", "Señor", "Monsieur", "Madame", "Mademoiselle", "госпо", "Госпо", "AKIA", "ASIA")
HINTS_IN_ANY_CASE = ("passw", "pwd", "token", "secret", "api")

#: surrogates are made anew at most so often; spaces grow with the attempts, so only a defect could need more
MOST_ATTEMPTS = 64

_LATIN = "ba be bi bo da de di do fa fe ga go ka ke ki la le li lo ma me mi mo na ne ni no ra re ri ro sa se ta te ti to va ve vi".split()
_CYRILLIC = "ба бе би бо да де ди до ва ве га го ка ке ки ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се та те ти то за зо".split()

ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())


def findings(text: Column) -> Column:
    """All findings of a text in order; empty for a text without or null."""
    none = F.array().cast("array<string>")
    hint = text.rlike("[0-9@]")
    for word in HINTS:
        hint = hint | text.contains(word)
    for word in HINTS_IN_ANY_CASE:
        hint = hint | F.lower(text).contains(word)
    return F.when(hint, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def kind_of(found: Column, gap: Column) -> Column:
    """The kind of a finding, by its shape; a name also needs a title at the end of the text before it."""
    digits = F.regexp_replace(found, r"\D", "")
    return (
        F.when(found.rlike(f"^(?:{PATTERNS['mail']})$"), "mail")
        .when(found.rlike(f"^(?:{PATTERNS['address']})$"), "address")
        .when(found.rlike(f"^(?:{PATTERNS['address6']})$"), "address6")
        .when(found.rlike(f"^(?:{PATTERNS['social']})$"), "social")
        .when(found.rlike(f"^(?:{PATTERNS['card']})$"), "card")
        .when(found.rlike(f"^(?:{PATTERNS['phone']})$"), "phone")
        .when(found.rlike(f"^(?:{PATTERNS['access_key']})$"), "access_key")
        .when(found.rlike(f"^(?:{PATTERNS['bank']})$") & (F.char_length(digits) >= 6), "bank")
        .when(found.rlike(f"^{NAME_WORD}(?: {NAME_WORD})?$") & gap.rlike(rf"\b(?:{MALE}|{FEMALE})\.? $"), "name")
        .otherwise("secret")
    )


def normal_form(kind: Column, found: Column) -> Column:
    return (
        F.when(kind.isin("phone", "card", "social"), F.regexp_replace(found, r"\D", ""))
        .when(kind == "bank", F.replace(found, F.lit(" "), F.lit("")))
        .when(kind.isin("mail", "address6"), F.lower(found))
        .otherwise(found)
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named; a lambda would compute it in every step."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bytes(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """Pseudo-random bytes as an array of numbers, at least one for each character of the normal form."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), normal)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.char_length(normal) / 32).cast("int") + 1),
        lambda block: F.sha2(F.concat(block.cast("string"), F.lit("\x1f"), seed).cast("binary"), 256),
    )
    at = F.sequence(F.lit(0), F.char_length(normal) + 31)
    return _let(
        F.array_join(blocks, ""),
        lambda digits: F.transform(at, lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int")),
    )


def surrogate(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """Surrogate of a normal form; other attempts give others."""
    return _let(_bytes(key, kind, normal, attempt), lambda drawn: _drawn_surrogate(kind, normal, attempt, drawn))


def _drawn_surrogate(kind: Column, normal: Column, attempt: Column, drawn: Column) -> Column:
    no_letters = ~normal.rlike(r"[\p{L}\p{N}]")  # a secret of marks gets letters, else it would be its own surrogate

    def same_class(c: Column, value: Column) -> Column:
        # a number in hexadecimal digits stays one
        letters = F.when(normal.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 6).otherwise(26)
        letter = lambda first: F.char(F.lit(ord(first)) + value % letters)
        return (
            F.when(c.rlike("[0-9]"), (value % 10).cast("string"))
            .when(c.rlike("[a-z]"), letter("a"))
            .when(c.rlike("[A-Z]"), letter("A"))
            .when(c.rlike(r"\p{L}") | no_letters, letter("a"))
            .when(c.rlike(r"\p{N}"), (value % 10).cast("string"))
            .otherwise(c)
        )

    def swapped(text: Column, keep: Column) -> Column:
        """Characters from the ``keep``-th on, each by one of its class."""
        return F.array_join(
            F.transform(
                F.split(text, ""), lambda c, i: F.when(i < keep, c).otherwise(same_class(c, F.get(drawn, i)))
            ),
            "",
        )

    # few surrogates are as short as some secrets and mail names: attempts from the third on add a character each
    more = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.greatest(attempt - 2, F.lit(1))),
            lambda k: _let(
                F.get(drawn, (F.char_length(normal) + 1 + k) % F.size(drawn)),
                lambda value: F.when(attempt < 3, "")
                .when(normal.rlike(r"^[^\p{L}]*\p{N}[^\p{L}]*$"), (value % 10).cast("string"))
                .otherwise(F.char(F.lit(ord("a")) + value % 26)),
            ),
        ),
        "",
    )
    local, domain = F.substring_index(normal, "@", 1), F.substring_index(normal, "@", -1)
    reserved = F.array(*map(F.lit, ("example.com", "example.net", "example.org")))
    host = F.concat(
        F.regexp_replace(swapped(F.substring_index(domain, ".", 1), F.lit(0)), r"[^A-Za-z0-9]", "x"),
        F.lit("."),
        F.get(reserved, F.get(drawn, F.char_length(normal) + 1) % 3),
    )
    octets = F.transform(F.split(normal, r"\."), lambda _, i: (F.get(drawn, i) % 254 + 1).cast("string"))
    return (
        F.when(kind == "mail", F.concat(swapped(local, F.lit(0)), more, F.lit("@"), host))
        .when(kind == "address", F.array_join(octets, "."))
        .when(kind == "address6", _address6(normal, drawn))
        .when(kind == "card", _let(swapped(F.substring(normal, F.lit(1), F.char_length(normal) - 1), F.lit(0)), _luhn))
        .when(kind == "phone", swapped(normal, F.when(F.char_length(normal) > 10, 1).otherwise(0)))
        .when(kind == "access_key", swapped(normal, F.lit(4)))
        .when(kind == "bank", _let(swapped(normal, F.lit(2)), _bank))
        .when(kind.startswith("name"), _name(kind, normal, drawn, attempt))
        .otherwise(F.concat(swapped(normal, F.lit(0)), more))
    )


def _luhn(body: Column) -> Column:
    """A card number from all its digits but the last, which is the check digit."""

    def weighed(digit: Column, i: Column) -> Column:
        twice = digit.cast("int") * 2
        return F.when((F.char_length(body) - i) % 2 == 0, digit.cast("int")).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    total = F.aggregate(F.transform(F.split(body, ""), weighed), F.lit(0), lambda a, b: a + b)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def _bank(number: Column) -> Column:
    """A bank number with its two check digits, by remainders of 97."""
    moved = F.split(F.concat(F.substring(number, 5, 64), F.substring(number, 1, 2), F.lit("00")), "")

    def value(c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)

    rest = F.aggregate(
        F.transform(moved, value), F.lit(0), lambda rest, v: (rest * F.when(v > 9, 100).otherwise(10) + v) % 97
    )
    check = F.lpad((98 - rest).cast("string"), 2, "0")
    return F.concat(F.substring(number, 1, 2), check, F.substring(number, 5, 64))


def _address6(normal: Column, drawn: Column) -> Column:
    """The first group stays, as it tells what the address is for; other groups get four new digits."""

    def group(part: Column, i: Column) -> Column:
        high, low = F.get(drawn, (2 * i) % F.size(drawn)), F.get(drawn, (2 * i + 1) % F.size(drawn))
        return F.when((i == 0) | (part == ""), part).otherwise(F.format_string("%x", 4096 + (high * 256 + low) % 61440))

    return F.array_join(F.transform(F.split(normal, ":"), group), ":")


def _name(kind: Column, normal: Column, drawn: Column, attempt: Column) -> Column:
    """For one word of a name; a first name ends as its gender does. Later attempts are longer."""
    cyrillic = normal.rlike(r"\p{IsCyrillic}")
    syllable = lambda value: F.when(cyrillic, F.get(_list(_CYRILLIC), value % len(_CYRILLIC))).otherwise(
        F.get(_list(_LATIN), value % len(_LATIN))
    )
    ending = (
        F.when(kind == "name_f", F.when(cyrillic, "на").otherwise("na"))
        .when(kind == "name_m", F.when(cyrillic, "н").otherwise("n"))
        .otherwise("")
    )
    # attempts from the third on add a syllable each, so there is always another name
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(2) + F.greatest(attempt - 2, F.lit(0))),
        lambda k: syllable(F.get(drawn, k % F.size(drawn)) + 7 * attempt * k),
    )
    return F.initcap(F.concat(F.array_join(parts, ""), ending))


def _list(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _shaped(kind: Column, found: Column, made: Column) -> Column:
    """The surrogate in the punctuation of the finding."""
    as_found = F.aggregate(
        F.split(found, ""),
        F.struct(F.lit("").alias("text"), F.lit(0).alias("used")),
        lambda state, c: F.when(
            c.rlike(r"[\p{L}\p{N}]"),
            F.struct(
                F.concat(state["text"], F.substring(made, state["used"] + 1, F.lit(1))).alias("text"),
                (state["used"] + 1).alias("used"),
            ),
        ).otherwise(F.struct(F.concat(state["text"], c).alias("text"), state["used"].alias("used"))),
        lambda state: state["text"],
    )
    return F.when(kind.isin("phone", "card", "social", "bank"), as_found).otherwise(made)


def _entities(kind: Column, found: Column, gap: Column) -> Column:
    """A finding behind ``gap`` as (gap, kind, normal, found): one, or one for each word of a name.

    The first of two words is a first name, of the gender that the title at the end of the gap tells.
    """

    def entity(gap: Column, kind: Column, found: Column) -> Column:
        return F.struct(
            gap.alias("gap"), kind.alias("kind"), normal_form(kind, found).alias("normal"), found.alias("found")
        )

    first = F.when(gap.rlike(rf"\b(?:{FEMALE})\.? $"), "name_f").otherwise("name_m")
    words = F.split(found, " ")
    return F.when(
        (kind == "name") & (F.size(words) > 1),
        F.array(entity(gap, first, F.get(words, F.lit(0))), entity(F.lit(" "), kind, F.get(words, F.lit(1)))),
    ).otherwise(F.array(entity(gap, kind, found)))


def _with_findings(df: DataFrame) -> DataFrame:
    """Add ``entities`` of ``text``, an array of (gap, kind, normal, found), and ``tail``, the text behind the last.

    In steps, so that a text is searched once for findings and once for the gaps between them.
    """
    found = df.withColumn("findings", findings(F.col("text")))
    gaps = F.when(F.size("findings") > 0, F.split(F.col("text"), ANY, -1))
    entities = F.flatten(
        F.transform(
            "findings",
            lambda found, i: _let(
                kind_of(found, F.get(F.col("gaps"), i)), lambda kind: _entities(kind, found, F.get(F.col("gaps"), i))
            ),
        )
    )
    return found.withColumn("gaps", gaps).withColumn("entities", entities).withColumn("tail", F.element_at("gaps", -1))


def _with_later_mentions(rows: DataFrame) -> DataFrame:
    """Cut the gaps at the words of the document's names, so that these are entities too."""
    names = F.filter("entities", lambda e: e["kind"].startswith("name"))
    # of several kinds the first: first names before family names
    family = lambda e: (e["kind"] == "name").alias("family")
    kinds = F.transform(names, lambda e: F.struct(e["found"].alias("word"), family(e), e["kind"].alias("kind")))
    known = rows.withColumn("words", F.array_distinct(F.transform(names, lambda e: e["found"])))
    known = known.withColumn("kinds", F.array_sort(F.array_distinct(kinds)))
    one = F.concat(F.lit(r"(?<![\p{L}\p{N}_])(?:"), F.array_join(F.reverse(F.array_sort("words")), "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    known = known.withColumn("pattern", F.when(F.size("words") > 0, one))

    def kind_of_word(word: Column) -> Column:
        return F.get(F.filter("kinds", lambda k: k["word"] == word), F.lit(0))["kind"]

    def cut(gap: Column) -> Column:
        """(entities, what follows the last)."""
        words = F.regexp_extract_all(gap, F.col("pattern"), F.lit(0))
        between = F.split(gap, F.col("pattern"), F.lit(-1))
        entities = lambda words, between: F.transform(
            words,
            lambda word, i: F.struct(
                F.get(between, i).alias("gap"), kind_of_word(word).alias("kind"), word.alias("normal"), word.alias("found")
            ),
        )
        return _let(
            F.struct(words.alias("words"), between.alias("between")),
            lambda c: F.struct(
                entities(c["words"], c["between"]).alias("entities"), F.element_at(c["between"], -1).alias("rest")
            ),
        )

    def with_gap(e: Column, gap: Column) -> Column:
        return F.struct(gap.alias("gap"), e["kind"].alias("kind"), e["normal"].alias("normal"), e["found"].alias("found"))

    known = known.withColumn("last", F.when(F.size("words") > 0, cut(F.col("tail"))))
    more = F.flatten(
        F.transform(
            "entities",
            lambda e: _let(cut(e["gap"]), lambda c: F.concat(c["entities"], F.array(with_gap(e, c["rest"])))),
        )
    )
    cut_up = F.when(F.size("words") > 0, F.concat(more, F.col("last.entities"))).otherwise(F.col("entities"))
    return known.withColumn("entities", cut_up).withColumn("tail", F.coalesce("last.rest", "tail"))


def later_attempts(entities: DataFrame, key: str) -> DataFrame:
    """(kind, normal, attempt) of the entities whose first surrogate clashes.

    ``entities`` has distinct (kind, normal). Each round checks all surrogates; clashes get rarer from round to round, as
    there are more surrogates to draw from. Only a kind whose surrogates are used up could go on, which is an error.
    """
    current = kept(entities.select("kind", "normal", F.lit(0).alias("attempt")))
    for _ in range(MOST_ATTEMPTS):
        made = kept(current.withColumn("made", surrogate(key, F.col("kind"), F.col("normal"), F.col("attempt"))))
        shared = made.groupBy("made").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "kind", "normal")).alias("first"))
        shared = shared.filter("n > 1").select("made", F.struct("first.kind", "first.normal").alias("first"))
        real = made.select(F.col("normal").alias("made"), F.lit(True).alias("real")).distinct()
        judged = made.join(shared, "made", "left").join(real, "made", "left")
        clash = F.col("real").isNotNull() | (
            F.col("first").isNotNull() & (F.col("first") != F.struct("kind", "normal"))
        )
        judged = kept(judged.select("kind", "normal", "attempt", F.coalesce(clash, F.lit(False)).alias("clash")))
        if judged.filter("clash").isEmpty():
            return judged.filter("attempt > 0").select("kind", "normal", "attempt")
        current = judged.select("kind", "normal", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))
    kinds = [row["kind"] for row in judged.filter("clash").select("kind").distinct().collect()]
    raise RuntimeError(f"more values than surrogates of the kinds {', '.join(sorted(kinds))}")


def pseudonymised(
    df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None
) -> DataFrame:
    """The rows with findings in ``text_col`` replaced; ``count_col`` names a column for their number.

    Each word of a name counts as one. Jobs run while the frame is built, to check all surrogates of the table.
    """
    if count_col in df.columns:
        raise ValueError(f"there is a column {count_col} already")
    searched = _with_findings(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    # outer, since else the optimizer searches all texts once more to drop those without findings
    mentions = searched.select("id", F.explode_outer("entities").alias("m")).filter("m is not null")
    mentions = kept(mentions.select("id", "m.kind", "m.normal").distinct())
    again = later_attempts(mentions.select("kind", "normal").distinct(), key)
    rows = df.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows, attempts = _with_later_mentions(_with_findings(rows)), F.lit(None).cast("map<string,int>")
    if not again.isEmpty():
        of_row = F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "kind", "normal"), "attempt")))
        by_row = mentions.join(again, ["kind", "normal"]).groupBy(F.col("id").alias("other")).agg(of_row.alias("attempts"))
        rows = rows.join(by_row, rows["id"].eqNullSafe(by_row["other"]), "left")
        attempts = F.col("attempts")

    def replaced(e: Column) -> Column:
        """What stands before the entity, and its surrogate."""
        attempt = F.coalesce(F.try_element_at(attempts, F.concat_ws(":", e["kind"], e["normal"])), F.lit(0))
        made = _let(surrogate(key, e["kind"], e["normal"], attempt), lambda made: _shaped(e["kind"], e["found"], made))
        return F.concat(e["gap"], made)

    made = rows.withColumn("made", F.transform("entities", replaced))
    joined = F.concat(F.array_join("made", ""), F.col("tail"))
    changed = F.when(F.size("entities") > 0, joined).otherwise(F.col("text"))
    return made.select(
        *((changed if c == text_col else F.col("row")[c]).alias(c) for c in df.columns),
        *([F.size("entities").cast("bigint").alias(count_col)] if count_col else []),
    )
