import re

from parchment.llm.license import BASE, _templates, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "Released under the MIT License. Also Apache-License; CC-BY 4.0, cc by, CC BY", "GNU General Public License, version 3", "mitlicense apache", "", None,
    "gnu general public library license", "the mit license mit license", "Permission is hereby granted, free of charge, to any human obtaining a copy of this software and associated documentation files",
    "permission is hereby granted free of charge", "CC BY", "ÀPACHE apache LICENSE é", "cc\nby-nc", "K " * 50 + "mit license",
]


def test_base_places(make):
    got = {r.id: r for r in scan_licenses(make(list(enumerate(TEXTS)))).collect()}
    for i, t in enumerate(TEXTS):
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        places = [(s, label) for phrase, label in BASE.items() for s in range(len(w)) if w[s : s + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(places)), t
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score == 0) == (r.labels == "")


def test_templates(make):
    got = {r.id: r for r in scan_licenses(make(list(enumerate(TEXTS)))).collect()}
    assert "mit-text" in got[7].labels and 0.75 <= got[7].score < 1 and got[8].labels == ""
    assert "gpl-3.0" in got[1].labels and "cc-by-nc" in got[11].labels


def test_odd(make, odd):
    assert scan_licenses(make(odd)).count() == len(odd) and scan_licenses(make([])).count() == 0


def test_odd_rows_against_plain_words(make, odd):
    got = sorted(str((r.id, r.n_words, r.n_base, r.first_word, r.labels, r.score)) for r in scan_licenses(make(odd)).collect())
    n = lambda t: len(WORD.findall((t or "").lower()))
    assert got == sorted(str((r[0], n(r[1]), 0, None, "", 0.0)) for r in odd)


def test_every_template_is_found_in_its_own_text(make):
    """Whole texts, in the middle of other words, with a fifth of the words outside the key phrase changed."""
    rows = []
    for i, t in enumerate(_templates()):
        words = list(t["words"])
        free = [k for k in range(len(words)) if not t["at"] <= k < t["at"] + len(t["key"])]
        for k in free[:: max(5, 1)]:
            words[k] = "changed"
        rows += [(2 * i, "some words before " + " ".join(words) + " and after"), (2 * i + 1, " ".join(words).replace(t["key"][0], "other", 1))]
    got = {r.id: r for r in scan_licenses(make(rows)).collect()}
    for i, t in enumerate(_templates()):
        own = {x.label: x.starts for x in got[2 * i].found}
        assert 3 in own[t["label"]], t["label"]
    assert [r.id for r in got.values() if r.labels == ""] != []
