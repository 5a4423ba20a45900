import re

import pytest

from riskfold.llm import licenses as L


def plain_scan(text):
    """The same rules, one text at a time."""

    def names(parts):
        clean = (re.sub("[^a-z0-9]+", " ", p.lower().replace("licence", "license")).strip() for p in parts)
        return [L.SENTENCES[c] for c in clean if c in L.SENTENCES]

    def rule(ids):
        rest, found = " " + "  ".join(ids) + " ", []
        for name, want in L.RULES:
            key = " " + "  ".join(want) + " "
            if key in rest:
                rest = rest.replace(key, " | ")
                found.append(name)
        return rest, found

    text = text or ""
    one = names(re.split(r"[\r\n]+|" + L.END, text))
    two = names(re.split(L.END, re.sub(r"\s+", " ", text)))
    (r1, f1), (r2, f2) = rule(one), rule(two)
    order = list(dict.fromkeys(n for n, _ in L.RULES))
    ids, rest = (two, r2) if len(two) > len(one) else (one, r1)
    return ids, [n for n in order if n in f1 + f2], [x for x in re.split("[ |]+", rest) if x]


MIT = [s for s, i in L.SENTENCES.items() if i in ("MITGrant", "MITNotice", "MITWarranty", "MITLiability")]
TEXTS = [
    None, "", "clean text. More of it", "Licensed under CC BY-NC 4.0.", "x\nReleased under the MIT License.\ny", "released under the mit licence",
    "RELEASED UNDER THE MIT LICENSE!", ". ".join(MIT) + ".", (". ".join(MIT) + ".").replace(" ", "\n  "), MIT[1] + ". All rights reserved.",
    "foo Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License.",
    "a permission b " * 20_000 + "\nThis work is licensed under the GNU General Public License, version 3.",
]


def test_every_sentence_has_a_mark_and_its_normal_form():
    for s, i in L.SENTENCES.items():
        assert any(m in s for m in L.MARKS), s
        assert s == re.sub("[^a-z0-9]+", " ", s).strip() and " " not in i
    assert {i for _, ids in L.RULES for i in ids} <= set(L.SENTENCES.values())


def test_against_plain_scan(spark):
    rows = [(i, t, None) for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "x"), (3, TEXTS[3], "x"), (3, TEXTS[3], "x")]
    out = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, Licenses string"))
    assert out.columns == ["doc_id", "text", "sentence_ids", "licenses", "loose_ids"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.sentence_ids, r.licenses, r.loose_ids) == plain_scan(r.text), r.text
    assert plain_scan(TEXTS[7])[1] == plain_scan(TEXTS[8])[1] == ["MIT"]


def test_whole_rule_goes_before_its_part(spark):
    text = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    text += ". ".join(s for s, i in L.SENTENCES.items() if i in ("BSDSource", "BSDBinary", "BSDWarranty"))
    assert plain_scan(text)[1] == ["BSD-2-Clause"]


def test_empty_table_and_no_python(spark):
    out = L.scan_licenses(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0
    assert not re.search("Python|Pandas|Arrow|Exchange", out._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", [n for n, _ in L.RULES])
def test_each_licence_can_be_found(name):
    ids = next(i for n, i in L.RULES if n == name)
    back = {i: s for s, i in L.SENTENCES.items()}
    assert plain_scan(". ".join(back[i] for i in ids) + ".")[1] == [name]


WRAPPED = [
    "All rights\nreserved.", "x.\nAll  rights\r\n\treserved.\ny", "All rights - reserved", "All rights\u00a0reserved.",
    "This is free and unencumbered software released into the public\ndomain.", "This is free and unencumbered software released into the public-domain!",
]


def test_wrapped_notices_without_another_mark(spark):
    got = L.scan_licenses(spark.createDataFrame(list(enumerate(WRAPPED)), "doc_id int, text string")).collect()
    assert len(got) == len(WRAPPED)
    for r in got:
        assert (r.sentence_ids, r.licenses, r.loose_ids) == plain_scan(r.text) and len(r.sentence_ids) == 1, r.text
    assert all(" " not in m for m in L.MARKS)
