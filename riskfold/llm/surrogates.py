"""Personal data replaced by keyed surrogates of the same type, script and format.

Detection finds e-mail and IP addresses (v4 and v6), phone, card, bank and
identity numbers, secrets (long hexadecimal strings), and personal names (behind
a title, behind a phrase such as "name is", or starting with a listed given
name; up to four words).  An entity is a type and a canonical form: how a mention
is written (case, separators, title) does not matter, so all its mentions in the
corpus get one surrogate (coreference).  Within a text the family name of one
full name alone, with a title or without, is that person.  What else a
draw depends on is settled for each entity, not for each mention: a name's
gender is the one that its mentions show, and unknown where they show both.

A surrogate is drawn from SHA-512 of key, type, canonical form and attempt.
Digits become digits and letters letters of the same script and case, in the
mention's own format; card numbers that pass the Luhn check still do; addresses
stay valid; names keep their gender, script and number of words.

Collision check: over all entities of the corpus, two must not share a
surrogate, and none may get another entity's own form.  The losers draw again
until none is left.  The first ``SAME_LENGTH`` draws keep the length; where so
many collide the space is too small (a lone name of two letters), and each
further draw is one character longer than the one before: names at their end,
e-mail addresses at their start, numbers at their end; an IP address becomes a
private IPv6 address.  So no number of entities exhausts it.  Letters outside
the Latin, Cyrillic and Greek scripts become Latin letters.  First draws are computed in place; only losers (few: the
spaces are large) and names of two words whose mentions differ in gender are
joined, so other common entities are no hot join key and texts without any of
these are not shuffled.

Everything is DataFrame and SQL functions.  Rules: NULL and empty texts pass
unchanged; mentions are found from the left and do not overlap; repeated rows
get equal results; an empty table gives no rows; ``entities`` gives way.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfold.llm.common import let, saved, text_key, without

# Given names by gender, and titles by gender (n: either).
GIVEN = {
    "f": "Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Karen Emma Anna Julia Laura Sophie Marie Claire Camille Isabelle Lucia Carmen Elena Ingrid Helga Greta Ольга Анна Мария Елена Наталья Μαρία Ελένη Σοφία",
    "m": "James Robert John Michael David William Richard Thomas Charles Daniel Peter Paul Jean Pierre Louis Antoine Carlos Miguel Javier Hans Klaus Jürgen Wolfgang Stefan Иван Сергей Алексей Дмитрий Владимир Γιώργος Νίκος Δημήτρης",
}
TITLES = {"f": "Mrs Ms Miss Frau Señora Madame Mme", "m": "Mr Herr Señor Monsieur", "n": "Dr Prof"}
SAME_LENGTH = 8

_HEX = "0123456789abcdef"
_NAME = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:-?\p{Lu}\p{Ll}+)*"
#: Not inside a word of any script.
_FREE, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
# What a full name may stand behind.
CUES = ("name is ", "Name: ", "Dear ", "Sincerely, ", "Regards, ", "signed ", "Signed ")


def _any(words: str) -> str:
    return "(?:" + "|".join(words.split()) + ")"


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
_IPV6 = (
    r"(?<![0-9A-Za-z:])(?=[0-9A-Fa-f]{1,4}:)(?=[A-Fa-f:]*[0-9])"
    r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])"
)
_PHONE = (
    r"(?<![\w+])\+?(?:\d{1,3}[ .-])?(?:\(\d{3}\)|\d{3})[ .-]\d{3}[ .-]\d{4}\b|(?<!\w)\+\d{8,14}\b"
    # international with groups of any size, national with a leading zero
    r"|(?<![\w+])(?=\+(?:[ .()-]{0,2}\d){8,15}(?![\d]))\+\d{1,3}(?:[ .-]\(?\d{1,4}\)?){2,6}(?!\w)"
    r"|(?<![\w+.-])(?=0(?:[ -]?\d){8,11}(?![ -]?\d))0\d{1,4}(?:[ -]\d{2,4}){2,4}(?!\w)"
)

#: Type and pattern, in the order in which they are tried at a position.
PATTERNS: list[tuple[str, str]] = [
    ("email", r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("secret", r"\b[0-9A-Fa-f]{32,}\b"),
    ("ip", f"{_IPV6}|{_IPV4}"),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b(?<=\d)"),
    ("card", r"\b\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}\b"),
    ("phone", _PHONE),
    (
        "name",
        rf"{_FREE}(?:{_any(' '.join(TITLES.values()))}\.? {_NAME}(?: {_NAME}){{0,2}}|{_any(GIVEN['f'] + ' ' + GIVEN['m'])}(?: {_NAME}){{1,3}}{_END}"
        rf"|(?<=\b(?:{'|'.join(CUES)})){_NAME}(?: {_NAME}){{1,3}}{_END})",
    ),
]
_OF = dict(PATTERNS)
#: One expression for all types.  What the next character is decides which are tried, so most positions cost one look;
#: back-references in it are by name.
ANY = "|".join(
    [
        f"(?<![A-Za-z0-9])(?=[A-Za-z0-9])(?:{_OF['email']}|{_OF['secret']}|{_IPV6})",
        f"(?=[0-9+(])(?:{_IPV4}|{_OF['ssn']}|{_OF['card']}|{_OF['phone']})",
        rf"(?=\p{{Lu}})(?:{_OF['iban']}|{_OF['name']})",
    ]
).replace("([ -]?)", "(?<sep>[ -]?)").replace(r"\1", r"\k<sep>")


def _type(m: Column) -> Column:
    kind = F.lit("name")
    for name, pattern in reversed(PATTERNS[:-1]):
        kind = F.when(m.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string, modulo 10."""
    n = F.length(digits)
    each = F.transform(
        F.split(digits, ""),
        lambda c, i: F.when((n - i) % 2 == 0, F.element_at(F.array(*[F.lit((2 * d) // 10 + (2 * d) % 10) for d in range(10)]), c.cast("int") + 1)).otherwise(c.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


def _canonical(kind: Column, m: Column) -> Column:
    """What identifies an entity: digits alone for numbers, the name without its title, else the mention in lower case."""
    name = F.lower(F.regexp_replace(m, rf"^{_any(' '.join(TITLES.values()))}\.? ", ""))
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(m, r"\D", ""))
        .when(kind == "iban", F.lower(F.replace(m, F.lit(" "))))
        .when(kind == "name", name)
        .otherwise(F.lower(m))
    )


def _gender(m: Column) -> Column:
    """Of a name: by its title, else by its given name, else n."""
    known = F.lit("n")
    for g in ("m", "f"):
        known = F.when(m.rlike(rf"\b{_any(GIVEN[g])}\b"), F.lit(g)).otherwise(known)
    for g in ("m", "f"):
        known = F.when(m.rlike(rf"^{_any(TITLES[g])}\b"), F.lit(g)).otherwise(known)
    return known


def _detail(kind: Column, m: Column, canonical: Column) -> Column:
    """What else a draw depends on: the gender of a name with a given name, whether a card number passes the Luhn check."""
    card = F.when(_luhn(canonical) == 0, F.lit("luhn")).otherwise(F.lit(""))
    gender = F.when(F.contains(canonical, F.lit(" ")), _gender(m)).otherwise(F.lit("n"))  # a lone name is invented in any case
    return F.when(kind == "name", gender).when(kind == "card", card).otherwise(F.lit(""))


def _letters(c: Column, hexdigit: Column, vowel: Column) -> Column:
    """A letter or digit of the class of ``c`` for a hexadecimal digit."""
    pick = lambda row: F.translate(hexdigit, _HEX, row)
    latin = F.when(vowel, pick("aeiouaeiouaeioua")).otherwise(pick("bdfghklmnprstvwz"))
    return (
        F.when(c.rlike("[0-9]"), pick("0123456789012345"))
        .when(c.rlike("[a-z]"), latin)
        .when(c.rlike(r"\p{IsCyrillic}"), F.when(vowel, pick("аеиоуаеиоуаеиоуа")).otherwise(pick("бвгдзклмнпрстфхш")))
        .when(c.rlike(r"\p{IsGreek}"), F.when(vowel, pick("αεηιοωαεηιοωαεηι")).otherwise(pick("βγδζθκλμνξπρστφχ")))
        .when(c.rlike(r"\p{IsLatin}"), F.when(vowel, pick("áéíóúàèìòùâêîôûä")).otherwise(pick("bdfghklmnprstvwz")))
        .when(c.rlike(r"\p{L}"), latin)
        .otherwise(c)
    )


def _drawn(kind: Column, canonical: Column, detail: Column, attempt: Column, key: str) -> Column:
    """The surrogate's canonical form; drawn over a longer one once ``SAME_LENGTH`` draws have collided."""
    seed = lambda part: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canonical, attempt.cast("string"), F.lit(part)), 512)
    stream, more = seed("a"), seed("b")
    bits = F.concat(stream, more)
    hexdigit = lambda i: F.substring(bits, F.pmod(i, F.lit(256)) + 1, F.lit(1))
    extra = F.greatest(attempt - (SAME_LENGTH - 1), F.lit(0))
    canonical = (
        F.when(extra == 0, canonical)
        .when(kind == "name", F.concat(canonical, F.repeat(F.substring(canonical, -1, 1), extra)))
        .when(kind == "email", F.concat(F.repeat(F.lit("a"), extra), canonical))
        .otherwise(F.concat(canonical, F.repeat(F.lit("0"), extra)))
    )
    chars = F.split(canonical, "")
    filled = F.array_join(F.transform(chars, lambda c, i: _letters(c, hexdigit(i), i % 2 == 1)), "")
    # an e-mail address keeps its top-level domain, an identity's country letters stay
    email = F.concat(F.substring(filled, F.lit(1), F.length(canonical) - F.length(F.substring_index(canonical, ".", -1))), F.substring_index(canonical, ".", -1))
    iban = F.concat(F.substring(canonical, 1, 2), F.substring(filled, F.lit(3), F.length(canonical)))
    secret = F.array_join(F.transform(chars, lambda c, i: hexdigit(i)), "")
    octet = lambda i: (F.conv(F.substring(stream, 1 + 4 * i, 4), 16, 10).cast("int") % 254 + 1).cast("string")
    ipv6 = F.concat_ws(":", F.concat(F.lit("fd"), F.substring(stream, 1, 2)), *[F.substring(stream, 4 * i + 1, 4) for i in range(1, 8)])
    ip = F.when((extra == 0) & ~F.contains(canonical, F.lit(":")), F.concat_ws(".", octet(0), octet(1), octet(2), octet(3))).otherwise(ipv6)
    body = F.concat(F.substring(canonical, 1, 1), F.substring(filled, F.lit(2), F.length(canonical) - 2))
    check = (F.lit(10) - _luhn(F.concat(body, F.lit("0")))) % 10
    card = F.when(detail == "luhn", F.concat(body, check.cast("string"))).otherwise(F.concat(body, F.substring(filled, -1, 1)))
    phone = F.concat(F.substring(canonical, F.lit(1), F.greatest(F.lit(1), F.length(canonical) - 10)), F.substring(filled, F.greatest(F.lit(1), F.length(canonical) - 10) + 1, F.lit(20)))
    return (
        F.when(kind == "email", email)
        .when(kind == "secret", secret)
        .when(kind == "ip", ip)
        .when(kind == "card", card)
        .when(kind == "iban", iban)
        .when(kind == "phone", phone)
        .when(kind == "name", _name(canonical, filled, detail, bits))
        .otherwise(filled)
    )


def _name(canonical: Column, filled: Column, gender: Column, bits: Column) -> Column:
    """A given name of the same gender and script, then invented family names of the same length."""
    rank = F.conv(F.substring(bits, 200, 6), 16, 10).cast("int")
    script = F.when(canonical.rlike(r"\p{IsCyrillic}"), "c").when(canonical.rlike(r"\p{IsGreek}"), "g").otherwise("l")
    given = F.lit(None).cast("string")
    for g, names in GIVEN.items():
        lists: dict[str, list[str]] = {"c": [], "g": [], "l": []}
        for n in names.lower().split():
            lists["c" if "а" <= n[0] <= "я" else "g" if "α" <= n[0] <= "ω" else "l"].append(n)
        for s, own in lists.items():
            given = F.when((gender == g) & (script == s), F.element_at(F.array(*map(F.lit, own)), rank % len(own) + 1)).otherwise(given)
    words = F.split(canonical, " ")
    # a lone name, or one of unknown gender, is invented as a whole
    return F.when(given.isNull() | (F.size(words) < 2), filled).otherwise(
        F.concat_ws(" ", given, F.substring(filled, F.length(F.substring_index(canonical, " ", 1)) + 2, F.length(canonical)))
    )


def _written(kind: Column, m: Column, drawn: Column) -> Column:
    """The drawn form in the mention's format: its separators, its case, its title."""
    digits = F.transform(F.split(m, ""), lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.lit(1)).otherwise(F.lit(0)))
    spaced = F.array_join(
        F.transform(
            F.split(m, ""),
            lambda c, i: F.when(
                c.rlike("[0-9A-Za-z]"),
                F.substring(drawn, F.aggregate(F.slice(digits, F.lit(1), i + 1), F.lit(0), lambda a, x: a + x), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    own = F.length(F.regexp_replace(m, "[^0-9A-Za-z]", ""))
    spaced = F.concat(spaced, F.substring(drawn, own + 1, F.length(drawn)))  # what a longer draw has more
    cased = F.array_join(
        F.transform(F.split(drawn, ""), lambda c, i: F.when(F.substring(m, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), ""
    )
    title = F.regexp_extract(m, rf"^{_any(' '.join(TITLES.values()))}\.? ", 0)
    return (
        F.when(kind.isin("phone", "card", "ssn"), spaced)
        .when(kind == "iban", F.upper(spaced))
        .when(kind == "name", F.concat(title, F.initcap(drawn)))
        .when(kind == "ip", drawn)
        .otherwise(cased)
    )


def _family(name: Column) -> Column:
    return F.substring_index(name, " ", -1)


def _with_mentions(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``_families``, the family names that stand for one full name of their text, and ``_m``.

    ``_m``: array<struct(mention, kind, canonical, detail, last)> in text order.  A name of one word (behind a title,
    or one of ``_families`` alone) that is the family name of exactly one full name of the text is that person:
    ``last`` says that the mention shows the last word only.
    """
    text = F.col(text_col)
    first = docs.withColumn("_first", F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    bare = lambda m: F.regexp_replace(m, rf"^{_any(' '.join(TITLES.values()))}\.? ", "")
    full = F.array_distinct(F.transform(F.filter("_first", lambda m: m.rlike(rf"^\p{{L}}[^@0-9]* {_NAME}$") & F.contains(bare(m), F.lit(" "))), bare))
    named = first.withColumn("_full", F.when(F.size("_first") > 0, full).otherwise(F.array().cast("array<string>")))
    family = F.filter(
        F.array_distinct(F.transform("_full", _family)), lambda f: F.size(F.filter("_full", lambda n: F.lower(_family(n)) == F.lower(f))) == 1
    )
    known = named.withColumn("_families", family)
    found = F.when(F.size("_families") > 0, F.regexp_extract_all(text, _own_pattern(), F.lit(0))).otherwise(F.col("_first"))
    typed = known.withColumn("_found", F.transform(found, lambda m: F.struct(m.alias("mention"), _type(m).alias("kind"))))

    def linked(t: Column) -> Column:
        own = _canonical(t["kind"], t["mention"])
        owner = F.get(F.filter("_full", lambda n: F.lower(_family(n)) == own), F.lit(0))
        of_one = (t["kind"] == "name") & ~F.contains(own, F.lit(" ")) & F.exists("_families", lambda f: F.lower(f) == own)
        return F.struct(
            t["mention"].alias("mention"), t["kind"].alias("kind"), F.when(of_one, F.lower(owner)).otherwise(own).alias("canonical"),
            # a family name alone says as much of the gender as the full name does
            F.when(of_one & (_gender(t["mention"]) == "n"), owner).otherwise(t["mention"]).alias("shown"), F.coalesce(of_one, F.lit(False)).alias("last"),
        )

    joined = typed.withColumn("_linked", F.transform("_found", linked))
    mentions = F.transform(
        "_linked",
        lambda t: F.struct(
            t["mention"].alias("mention"), t["kind"].alias("kind"), t["canonical"].alias("canonical"),
            _detail(t["kind"], t["shown"], t["canonical"]).alias("detail"), t["last"].alias("last"),
        ),
    )
    return joined.withColumn("_m", mentions).drop("_first", "_full", "_found", "_linked")


def _own_pattern() -> Column:
    """``ANY`` or one of the text's ``_families`` as a word."""
    names = F.array_join(F.transform("_families", lambda f: F.concat(F.lit(r"\Q"), f, F.lit(r"\E"))), "|")
    return F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}_'’-])(?:"), names, F.lit(r")(?![\p{L}\p{N}_-])"))


def _settled(mentions: DataFrame) -> DataFrame:
    """(kind, canonical, detail, mixed): each entity with the one detail of all its draws, and whether its mentions differ in it."""
    seen = mentions.groupBy("kind", "canonical").agg(
        F.min("detail").alias("a"), F.max("detail").alias("z"), F.min(F.when(F.col("detail") != "n", F.col("detail"))).alias("f"),
        F.max(F.when(F.col("detail") != "n", F.col("detail"))).alias("m"),
    )
    mixed = F.col("a") != F.col("z")
    # one gender beside unknown is known; two genders are unknown
    detail = F.when(~mixed, F.col("a")).when(F.col("f") == F.col("m"), F.col("f")).otherwise(F.lit("n"))
    return seen.select("kind", "canonical", detail.alias("detail"), mixed.alias("mixed"))


def _losers(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, attempt) of the entities whose first draw collides, with an attempt that does not."""
    state = saved(
        entities.select("kind", "canonical", "detail", F.lit(0).alias("attempt"))
        .withColumn("drawn", _drawn(F.col("kind"), F.col("canonical"), F.col("detail"), F.col("attempt"), key)),
        "surrogates",
    )
    for attempt in count(1):
        # of those that share a draw, the one that has waited longest and then the least keeps it
        keeper = state.groupBy("kind", "drawn").agg(F.min(F.struct("attempt", "canonical")).alias("first"), F.count(F.lit(1)).alias("n"))
        shared = keeper.filter("n > 1").select("kind", "drawn", "first")
        real = state.select("kind", F.col("canonical").alias("drawn"), F.lit(True).alias("real"))
        again = (
            state.join(shared, ["kind", "drawn"], "left")
            .join(real, ["kind", "drawn"], "left")
            .withColumn("lost", F.col("real").isNotNull() | (F.col("first").isNotNull() & (F.col("first.canonical") != F.col("canonical"))))
        )
        lost = saved(again.filter("lost").select("kind", "canonical", "detail"), "surrogate-losers")
        if lost.isEmpty():
            return state.filter("attempt > 0").select("kind", "canonical", "attempt")
        redrawn = lost.withColumn("attempt", F.lit(attempt)).withColumn(
            "drawn", _drawn(F.col("kind"), F.col("canonical"), F.col("detail"), F.lit(attempt), key)
        )
        state = saved(state.join(lost, ["kind", "canonical"], "left_anti").unionByName(redrawn), "surrogates")


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and ``entities`` (long): the number of mentions replaced."""
    kept = without(docs, ["entities"])
    own = ["kind", "canonical"]
    # the mentions without their texts, a row each: the entities and what is drawn again come from them
    narrow = saved(
        _with_mentions(kept.select(F.col(id_col).cast("string").alias("_id"), text_key(text_col).alias("_key"), F.col(text_col).alias("_text")), "_text")
        .select("_id", "_key", F.explode("_m").alias("m"))
        .select("_id", "_key", "m.kind", "m.canonical", "m.detail"),
        "mentions",
    )
    entities = saved(_settled(narrow), "entities")
    losers = (
        entities.join(_losers(entities, key), own, "left")
        .filter("mixed OR attempt IS NOT NULL")
        .select(*own, "detail", F.coalesce("attempt", F.lit(0)).alias("attempt"))
    )
    redrawn = narrow.drop("detail").join(losers, own).groupBy("_id", "_key").agg(F.collect_set(F.struct(*own, "detail", "attempt")).alias("_redrawn"))
    same = F.col(id_col).cast("string").eqNullSafe(F.col("_id")) & (text_key(text_col) == F.col("_key"))
    joined = _with_mentions(kept.join(saved(redrawn, "redrawn"), same, "left").drop("_id", "_key"), text_col)
    again = lambda m: F.get(F.filter("_redrawn", lambda r: (r["kind"] == m["kind"]) & (r["canonical"] == m["canonical"])), F.lit(0))
    # NULL where nothing is carried: the filter of a NULL array is NULL, so the first draw and the mention's detail stand
    looked_up = F.transform("_m", lambda m: F.struct(m.alias("m"), again(m).alias("r")))
    settled = F.transform(
        looked_up,
        lambda x: F.struct(
            x["m"]["mention"].alias("mention"), x["m"]["kind"].alias("kind"), x["m"]["canonical"].alias("canonical"), x["m"]["last"].alias("last"),
            F.coalesce(x["r"]["detail"], x["m"]["detail"]).alias("detail"), F.coalesce(x["r"]["attempt"], F.lit(0)).alias("attempt"),
        ),
    )

    def surrogate(m: Column) -> Column:
        drawn = _drawn(m["kind"], m["canonical"], m["detail"], m["attempt"], key)
        return let(drawn, lambda d: _written(m["kind"], m["mention"], F.when(m["last"], _family(d)).otherwise(d)))

    text = F.col(text_col)
    # the same expression that found the mentions cuts the text around them
    gaps = F.when(F.size("_families") > 0, F.split(text, _own_pattern(), -1)).otherwise(F.split(text, ANY, -1))
    whole = F.array_join(F.flatten(F.zip_with(gaps, F.col("_swapped"), lambda g, s: F.array(g, F.coalesce(s, F.lit(""))))), "")
    done = joined.withColumn("_swapped", F.when(F.size("_m") > 0, F.transform(settled, surrogate))).withColumn(
        "_text", F.when(F.size("_swapped") > 0, whole).otherwise(text)
    )
    return done.select(
        *[F.col("_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in kept.columns],
        F.coalesce(F.greatest(F.size("_swapped"), F.lit(0)), F.lit(0)).cast("long").alias("entities"),
    )
