import re

from reviewcraft.llm import license_index as li
from tests.llm.fixtures import DOCS, empty_docs, odd_docs, odd_rows

TEXTS = [
    "Released under the MIT License.",
    "x y MIT  license and mit-license; MITlicense",
    "Licensed under the Apache License, Version 2.0.",
    "apache license and again the Apache License",
    "Licensed under CC BY-NC 4.0.",
    "cc by cc by",
    "This work is licensed under the GNU General Public License, version 3.",
    "gnu general public licenses",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "permission granted free of any charge to a person",
    "Éapache license",
    "apache license é",
    "no licence here",
    "long " * 30000 + "MIT License",
]


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in li.BASE_PHRASES.items():
        parts = phrase.split()
        places += [
            (i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts
        ]
    starts = [p for p, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def test_against_plain_search(spark):
    rows = [(1000 + i, t, "", "", 0) for i, t in enumerate(TEXTS)] + odd_rows()
    found = li.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(str((r["doc_id"], *(r[c] for c in columns))) for r in found) == sorted(
        str((r[0], *plain(r[1]))) for r in rows
    )
    labels = {r["doc_id"]: r["labels"] for r in found}
    assert labels[1000] == "mit" and labels[1002] == "apache,apache-2.0"
    assert labels[1004] == "cc-by,cc-by-nc-4.0" and labels[1006] == "gpl,gpl-3.0"
    assert labels[1008] == "mit" and labels[1009] == "" and labels[1012] == ""
    for r in found:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1.0 or not r["n_base"])


def test_notice_in_place_and_key_phrase():
    index = li.RareTokenIndex({}, li.LicenseParams())
    notice = li.TEMPLATES[1][1]
    [(label, start, share)] = index.matches(f"some words {notice} end".encode().split())
    assert (label, start, share) == ("mit", 2, 1.0)
    scrambled = " ".join(sorted(notice.split()))
    assert index.matches(scrambled.encode().split()) == []


def test_idf_counts_all_files(spark):
    idf = li.inverse_document_frequencies(odd_docs(spark))
    assert idf.keys() == li.template_words() and all(v >= 0 for v in idf.values())


def test_empty_and_clashing_columns(spark):
    assert li.scan_licenses(empty_docs(spark)).count() == 0
    clash = odd_docs(spark).withColumnRenamed("source", "labels").withColumnRenamed("lang", "matches")
    found = li.scan_licenses(clash)
    assert found.columns.count("labels") == 1 and found.count() == len(odd_rows())
