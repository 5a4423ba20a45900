import re

import pytest
from pyspark.sql import functions as F

from riskfold.llm import surrogates as S

KEY = "test key"


def _run(spark, rows, key=KEY):
    out = S.replace_entities(spark.createDataFrame(rows, "doc_id long, text string, Entities string"), key)
    assert out.columns == ["doc_id", "text", "entities"]
    return out


def _texts(spark, *texts, key=KEY):
    got = _run(spark, [(i, t, None) for i, t in enumerate(texts)], key).orderBy("doc_id").collect()
    return [r.text for r in got]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d // 10 + d % 10
    return total % 10


def test_types_and_formats(spark):
    before = [
        "mail Anna.K9@Mail3.example.com now", "ring +1 (017) 555-7713.", "from 169.122.221.182!!", "card 4532 0151 1283 0366 ok",
        "id 123-45-6789", 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"', "iban DE44 5001 0517 5407 3249 31.", "no data, version 2.0. 1234 x",
    ]
    shapes = [
        r"mail [A-Z][a-z]{3}\.[A-Z]\d@[A-Z][a-z]{3}\d\.[a-z]{7}\.com now", r"ring \+1 \(\d{3}\) \d{3}-\d{4}\.", r"from (\d{1,3}\.){3}\d{1,3}!!",
        r"card 4\d{3} \d{4} \d{4} \d{4} ok", r"id \d{3}-\d{2}-\d{4}", r'token = "[0-9a-f]{40}"', r"iban DE\d{2}( \d{4}){4} \d{2}\.", re.escape(before[-1]),
    ]
    after = _texts(spark, *before)
    for a, b, shape in zip(before, after, shapes, strict=True):
        assert re.fullmatch(shape, b), (a, b)
        assert (a == b) == (a == before[-1])
    card = re.sub(r"\D", "", after[3])
    assert luhn("4532015112830366") == 0 and luhn(card) == 0
    assert all(0 < int(x) < 256 for x in after[2].split(" ")[1].strip("!").split("."))


def test_coreference_and_key(spark):
    texts = ["a +1 (017) 555-7713 b", "+1 017 555 7713", "X@Y.example.com x@y.EXAMPLE.com", "4532-0151-1283-0366 4532015112830366"]
    phone, phone2, mails, cards = _texts(spark, *texts)
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(phone) == digits(phone2) != digits(texts[0])
    assert mails.split()[0].lower() == mails.split()[1].lower()
    assert digits(cards.split()[0]) == cards.split()[1]
    assert _texts(spark, *texts, key="other")[0] != phone


def test_names_keep_gender_and_script(spark):
    f, m, cyr, title, again = _texts(spark, "met Mary Miller today", "met JAMES x James Miller.", "это Ольга Петрова тут", "Mrs. Schmidt said", "Mary Miller")
    given = {g: {n for n in names.split()} for g, names in S.GIVEN.items()}
    assert f.split()[1] in given["f"] and f.split()[2] != "Miller" and f.split()[2][0].isupper()
    assert m.startswith("met JAMES x ") and m.split()[3] in given["m"]
    assert cyr.split()[1] in given["f"] and re.fullmatch("[А-Я][а-я]+", cyr.split()[2]) and cyr.split()[1][0] > "А"
    assert re.fullmatch(r"Mrs\. [A-Z][a-z]{6} said", title) and title != "Mrs. Schmidt said"
    assert again == " ".join(f.split()[1:3])


def test_collisions_are_redrawn(spark):
    """Few draws are possible here, so many collide: all end up distinct and no one's own."""
    real = S._drawn
    narrow = lambda kind, canonical, detail, attempt, key: F.concat(
        F.lit("x"), F.substring(real(kind, canonical, detail, attempt, key), 1, 2)
    )
    entities = spark.createDataFrame([("ssn", f"x{i:02d}", "") for i in range(12)], "kind string, canonical string, detail string")
    S._drawn = narrow
    try:
        lost = S._losers(entities, KEY)
        final = entities.join(lost, ["kind", "canonical"], "left").withColumn(
            "s", narrow(F.col("kind"), F.col("canonical"), F.col("detail"), F.coalesce("attempt", F.lit(0)), KEY)
        )
        got = final.collect()
    finally:
        S._drawn = real
    assert len({r.s for r in got}) == 12 and any(r.attempt for r in got)
    assert not {r.s for r in got} & {r.canonical for r in got}


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", None), (None, "a@b.example.org", None), (3, "a@b.example.org", None), (3, "a@b.example.org", None), (4, "w " * 30_000 + "a@b.example.org a@b.example.org", None)]
    got = _run(spark, rows).collect()
    assert len(got) == 6 and [r.entities for r in got if not r.text] == [0, 0]
    mail = {r.text.split()[-1] for r in got if r.text}
    assert len(mail) == 1 and mail != {"a@b.example.org"} and max(r.entities for r in got) == 2
    assert _run(spark, []).collect() == []


@pytest.mark.parametrize("kind", ["plan"])
def test_no_python_on_the_main_path(spark, kind):
    plan = _run(spark, [(1, "a@b.example.org", None)])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_mixed_titles_are_one_entity(spark):
    given = {g: set(names.split()) for g, names in S.GIVEN.items()}
    texts = ["Mrs Alex Stone", "Dr Alex Stone", "Prof. Alex Stone", "Mr Kim Berg", "Mrs Kim Berg", "Dr Kim Berg", "Mr Stone", "Dr Stone", "Dr Mary Hill", "Mary Hill"]
    bare = [re.sub(r"^(Mrs|Mr|Dr|Prof\.) ", "", t) for t in texts]
    after = [re.sub(r"^(Mrs|Mr|Dr|Prof\.) ", "", t) for t in _texts(spark, *texts)]
    of = {}
    for b, a in zip(bare, after, strict=True):
        assert of.setdefault(b, a) == a, (b, a)
    assert len(set(of.values())) == 4 and not set(of.values()) & set(bare)
    assert of["Alex Stone"].split()[0] in given["f"] and of["Kim Berg"].split()[0] not in given["f"] | given["m"]


def test_more_entities_than_short_forms(spark):
    """Two letters have 80 forms, and one script had none; longer names take the rest."""
    names = [f"{a}{b}" for a in "BDLTWXY" for b in "abcdefghijklmnopqrst"] + ["\u0531\u0562", "\u0532\u0561\u0562"]
    before = ", ".join(f"Mr {n}" for n in names)
    after = [x.removeprefix("Mr ") for x in _texts(spark, before)[0].split(", ")]
    assert len(after) == len(set(after)) == len(names) and not set(after) & set(names)
    assert all(re.fullmatch("[A-Z][a-z]+", a) and len(a) >= len(n) for n, a in zip(names, after, strict=True))
    assert any(len(a) > len(n) for n, a in zip(names, after, strict=True))


def test_longer_draws_of_each_kind(spark):
    rows = [
        ("name", "Mrs Mary Li", "mary li", "f", r"Mrs [A-Z][a-zé]+ [A-Z][a-z]{4}"), ("email", "A@b.co", "a@b.co", "", r"[A-Za-z]{4}@[a-z]\.co"),
        ("ssn", "123-45-6789", "123456789", "", r"\d{3}-\d{2}-\d{7}"), ("phone", "+12345678", "12345678", "", r"\+1\d{10}"),
        ("card", "4532-0151-1283-0366", "4532015112830366", "luhn", r"4\d{3}-\d{4}-\d{4}-\d{7}"), ("ip", "1.2.3.4", "1.2.3.4", "", r"fd[0-9a-f]{2}(:[0-9a-f]{4}){7}"),
        ("iban", "DE44 5001 0517", "de4450010517", "", r"DE\d{2} \d{4} \d{7}"), ("secret", "9b0b" * 8, "9b0b" * 8, "", "[0-9a-f]{35}"),
    ]
    df = spark.createDataFrame(rows, "kind string, m string, canonical string, detail string, shape string").withColumn("attempt", F.lit(S.SAME_LENGTH + 2))
    drawn = S._drawn(F.col("kind"), F.col("canonical"), F.col("detail"), F.col("attempt"), KEY)
    for r in df.withColumn("drawn", drawn).withColumn("s", S._written(F.col("kind"), F.col("m"), F.col("drawn"))).collect():
        assert re.fullmatch(r.shape, r.s), (r.kind, r.s)
        assert r.kind != "card" or luhn(re.sub(r"\D", "", r.s)) == 0


def test_partial_names_in_one_text(spark):
    before = "Mary Miller wrote. Mrs Miller said. Miller left. Mr Stone and Ms Stone met Mary Jane Hill; Hill, hill and Hillary stayed."
    after = _texts(spark, before, "Miller alone. Mrs Miller too.")
    full = re.match(r"(\S+ \S+) wrote\. Mrs (\S+) said\. (\S+) left\. Mr (\S+) and Ms (\S+) met (\S+ \S+ \S+); (\S+), hill and Hillary stayed\.", after[0])
    given, family = full[1].split()
    assert given in S.GIVEN["f"].split() and family == full[2] == full[3] != "Miller"
    assert full[4] == full[5] != "Stone"  # no full name to belong to: one entity of one word
    assert full[7] == full[6].split()[-1] != "Hill" and len(full[6].split()) == 3
    assert re.fullmatch(r"Miller alone\. Mrs [A-Z][a-z]{5} too\.", after[1]) and "Mrs Miller" not in after[1]


def test_one_family_name_of_two_people_links_to_neither(spark):
    (after,) = _texts(spark, "Mary Miller and James Miller met. Mrs Miller left, Miller stayed.")
    a, b, lone = re.fullmatch(r"(\S+ \S+) and (\S+ \S+) met\. Mrs (\S+) left, Miller stayed\.", after).groups()
    assert "Miller" not in a + b + lone and lone not in a.split() + b.split()


def test_wider_forms(spark):
    before = [
        "call 06 12 34 56 78 now", "call +44 20 7946 0958.", "host 2001:db8:0:0:8a2e:370:7334:1 up", "host fe80::1ff:fe23:4567:890a up", "my name is Priya Sharma, hi",
        "Dear Wei Zhang,", "Mr McDonald and Mrs O'Brien", "on 01.02.2023 at 12:30:45, 01-02-2023, std::vector a::b",
    ]
    shapes = [
        r"call 0\d( \d\d){4} now", r"call \+44 \d\d \d{4} \d{4}\.", r"host fd[0-9a-f]{2}(:[0-9a-f]{4}){7} up", r"host fd[0-9a-f]{2}(:[0-9a-f]{4}){7} up", r"my name is [A-Z][a-z]{4} [A-Z][a-z]{5}, hi",
        r"Dear [A-Z][a-z]{2} [A-Z][a-z]{4},", r"Mr [A-Z][a-z]{7} and Mrs [A-Z]'[a-z]{5}", re.escape(before[-1]),
    ]
    for a, b, shape in zip(before, _texts(spark, *before), shapes, strict=True):
        assert re.fullmatch(shape, b), (a, b)
        assert (a == b) == (a == before[-1])


def test_the_quick_expression_finds_what_the_patterns_find(spark):
    """Each type's own pattern at every position against the one expression that looks at the next character first."""
    texts = ["x a.b@c.de,a@b.co;9a@x.org -q@z.io éa@b.de", "1.2.3.4 v1.2.3.4 10.0.0.256 1.2.3.4.5", "12-123-45-6789 123-45-6789 1234 5678 9012 3456", "+49 (030) 123-4567 DE44500105175407324931x GB29NWBK60161331926819",
             "é123-45-6789 " + "af" * 16 + " g" + "0" * 40, "xMary Hill Mary Hill. Ольга Петрова Dr. Hill-Stone Prof Γιώργος"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    named = [p.replace("([ -]?)", "(?<sep>[ -]?)").replace(r"\1", r"\k<sep>") for _, p in S.PATTERNS]
    plain = "|".join(f"(?:{p})" for p in named)
    for r in df.select("t", F.regexp_extract_all("t", F.lit(S.ANY), F.lit(0)).alias("a"), F.regexp_extract_all("t", F.lit(plain), F.lit(0)).alias("b")).collect():
        assert r.a == r.b, r.t
