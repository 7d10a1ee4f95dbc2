import random

import pytest

from crownledger.llm import licenses as L

SCANNER = L.Scanner()


def names(text):
    return [n.license for n in SCANNER.notices(text.encode())]


@pytest.mark.parametrize("name", list(L.TEMPLATES))
def test_every_template_is_found_in_prose(name):
    text = L.TEMPLATES[name]
    for before, after in (("", ""), ("some words of prose before it. ", "\nand after it"), ("x " * 500, " y" * 500)):
        found = SCANNER.notices((before + text + after).encode())
        assert [n.license for n in found] == [name] and found[0].differences == ()
        assert found[0].similarity == 1.0 and text.startswith((before + text + after)[found[0].start : found[0].end][:-1])


@pytest.mark.parametrize("name", [n for n, t in L.TEMPLATES.items() if len(t.split()) > 20])
def test_changed_wording_is_reported_up_to_a_fifth(name):
    rng = random.Random(1)
    words = L.TEMPLATES[name].split()
    few, many = list(words), list(words)
    for at in rng.sample(range(1, len(words)), len(words) // 10):
        few[at] = "changed"
    for at in rng.sample(range(len(words)), len(words) // 2):
        many[at] = "changed"
    found = SCANNER.notices(" ".join(few).encode())
    assert [n.license for n in found] == [name] and "+changed" in found[0].differences and found[0].similarity >= 0.8
    assert name not in names(" ".join(many))


def test_several_notices_in_order():
    order = ["MIT", "GPL-short", "Apache", "CC-short", "MIT", "MIT-short", "ISC"]
    text = "\nsome other line of text\n".join(L.TEMPLATES[n] for n in order)
    assert names(text) == order
    assert names((L.TEMPLATES["GPL-short"] + "\n" + L.TEMPLATES["MIT"] + "\n") * 200) == ["GPL-short", "MIT"] * 200


@pytest.mark.parametrize("name", ["MIT-short", "CC-short", "Rights-reserved", "Apache-short", "GPL-short", "CC"])
def test_short_notice_beside_cut_texts_is_found(name):
    """Cut texts of other licenses save more bytes, but are none themselves."""
    cut = [L.TEMPLATES[n].split() for n in ("MPL", "ISC", "BSD", "MIT")]
    near = "\n".join(" ".join(w[: len(w) * 6 // 10]) for w in cut)
    for text in (near + "\n" + L.TEMPLATES[name], L.TEMPLATES[name] + "\n" + near):
        assert names(text) == [name]


def plain_share(words, template):
    """The largest share of a template's words that any window of the text has in order, by all windows."""
    n, best = len(template), 0
    for i in range(max(1, len(words) - n // 2)):
        window = words[i : i + n + n // 4]
        row = [0] * (n + 1)  # longest common subsequence
        for w in window:
            last = 0
            for j, t in enumerate(template, 1):
                last, row[j] = row[j], last + 1 if w == t else max(row[j], row[j - 1])
        best = max(best, row[n])
    return best / n


@pytest.mark.parametrize("seed", range(6))
def test_notices_equal_all_windows_against_all_templates(seed):
    """Every template that some window has is reported, or a longer notice at its place; and nothing else is."""
    rng = random.Random(seed)
    parts = []
    for name in rng.sample(list(L.TEMPLATES), 4):
        words = L.TEMPLATES[name].split()
        kind = rng.choice(["whole", "changed", "cut"])
        if kind == "changed" and len(words) > 20:
            for at in rng.sample(range(1, len(words)), len(words) // 12):
                words[at] = "changed"
        parts += [" ".join(words[: len(words) // 2] if kind == "cut" else words), " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 30)))]
    text = "\n".join(parts)
    found = SCANNER.notices(text.encode())
    words = [w.lower() for w in L.WORD.findall(text.encode())]
    for template in SCANNER.templates:
        share = plain_share(words, template.words)
        reported = [n for n in found if n.license == template.name]
        assert share >= L.SIMILARITY or not reported
        if share >= L.SIMILARITY and not reported:
            inside = [n for n in found if plain_share([w.lower() for w in L.WORD.findall(text.encode()[n.start : n.end])], template.words) >= L.SIMILARITY]
            assert inside, template.name


def test_the_saving_decides(monkeypatch):
    """Without it the short notice inside a long one is taken first."""
    assert names(L.TEMPLATES["Apache"]) == ["Apache"]
    monkeypatch.setattr(L.Scanner, "savings", lambda self, block: [0] * len(self.templates))
    assert names(L.TEMPLATES["Apache"]) != ["Apache"]


def test_anchors_come_from_the_templates():
    own = {"house": "Guests must leave their umbrellas outside the kitchen before supper every evening of the week."}
    scanner = L.Scanner(own)
    assert [n.license for n in scanner.notices(("so " * 300 + own["house"] + " then " * 300).encode())] == ["house"]
    lacking = own["house"].replace("umbrellas", "").replace("outside", "")
    assert [n.license for n in scanner.notices(lacking.encode())] == ["house"]
    assert b"license" not in scanner.anchors and scanner.notices(b"license " * 50) == [] and L.Scanner({}).notices(b"license") == []


def test_versions_are_differences():
    found = SCANNER.notices(b"Licensed under the Apache License, Version 3.1.")
    assert found[0].license == "Apache-short" and found[0].differences == ("-2.0", "+3.1")


@pytest.mark.parametrize("text", ["", "license", "The license of the driver was lost; no permission was asked.", "copyright " * 5000])
def test_prose_is_no_notice(text):
    assert names(text) == []


def test_scan(spark, messy, nothing):
    texts = [(1, None), (2, "é " + L.TEMPLATES["MIT-short"]), (2, "é " + L.TEMPLATES["MIT-short"]), (None, L.TEMPLATES["GPL"])]
    rows = L.op5_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.license, r.start) for r in rows) == [(0, "GPL", 0), (2, "MIT-short", 2), (2, "MIT-short", 2)]
    assert L.op5_licenses(nothing).count() == 0 and L.op5_licenses(messy).count() == 0


def test_all_planted_notices(small):
    want = sorted(r.doc_id for r in small.filter("lower(text) like '%licensed under%' or lower(text) like '%mit license%'").collect())
    assert sorted(r.doc_id for r in L.op5_licenses(small).collect()) == want
