import re

from tests.llm.helpers import table
from tidemart.llm.licenses import PHRASES, TEMPLATES, needed, scan, scan_windows, template_words

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ROWS = [
    (1, None), (2, ""), (3, "!!"), (4, "All rights reserved."), (5, "ALL-RIGHTS\nreserved all rights  reserved"),
    (6, "first line\nLicensed under CC BY-NC 4.0.\nlast"), (7, "all rights are reserved"), (8, "xcc by cc byx cc\tby"),
    (9, "text\nReleased under the MIT License.\nThis work is licensed under the GNU General Public License, version 3."),
    (10, "Redistribution and use in source and binary forms, with or without any modification, are permitted here"),
    (11, "released under the mit"), (12, "éall rights reserved"), (13, "İcc by Kelvin"), (None, "cc by"), (14, "cc by"),
    (14, "cc by"), (14, "no license"), (15, "word " * 50_000 + "cc by " + "Licensed under the Apache License, Version 2.0."),
    (16, "Licensed under CC BY-SA 4.0. licensed nc"),
]


def brute_force(doc, text):
    data = (text or "").encode().lower()
    words = [x.decode() for x in WORD.findall(data)]
    places, labels, score = [], set(), 0.0
    for phrase, label in PHRASES:
        parts = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += here
        labels |= {label} if here else set()
    base = ",".join(sorted(labels))
    for block in data.split(b"\n"):
        held = {x.decode() for x in WORD.findall(block)}
        for template, label in TEMPLATES:
            wanted = template_words(template)
            if len(held & set(wanted)) >= needed(len(wanted)):
                labels.add(label)
                score = max(score, len(held & set(wanted)) / len(wanted))
    score = 1.0 if places else score
    return str((doc, len(words), len(places), min(places, default=None), max(places, default=None), base, ",".join(sorted(labels)), score))


def test_against_every_block_and_template(spark):
    docs = table(spark, ROWS, extra=("labels", "score", "_id", "words"))
    found = sorted(str(tuple(row)) for row in scan(docs).collect())
    assert found == sorted(brute_force(*row) for row in ROWS)
    assert scan(docs.limit(0)).count() == 0


def test_every_template_finds_itself():
    for template, label in TEMPLATES:
        assert label in brute_force(1, template)


def run_by_run(text, templates=TEMPLATES):
    """Every run of consecutive words against every template."""
    words = [x.decode() for x in WORD.findall((text or "").encode().lower())]
    found = {}
    for template, label, *key in templates:
        wanted, size = set(template_words(template)), len(re.findall("[0-9a-z]+", template.lower())) * 100 // 90
        for at in range(max(1, len(words) - size + 1)):
            held = len(wanted & set(words[at : at + size]))
            if held >= needed(len(wanted)):
                found[label] = max(found.get(label, 0), held / len(wanted))
    return ",".join(sorted(found)), max(found.values(), default=0.0)


WRAPPED = [
    (1, "/*\n * Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and\n */"),
    (2, "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided"),
    (3, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy"),
    (4, "all rights are reserved"), (4, "all the rights that were " + "not " * 40 + "reserved"), (None, "All rights\nreserved"),
    (5, "free to copy " * 30 + "permission is granted by any person hereby of this charge " + "x " * 30 + "obtaining a software"),
    (None, None), (6, ""), (6, "licensed nc 4.0 by cc under this"), (7, "word " * 3000 + "Released\n\nunder the\nMIT License"),
]


def test_runs_of_words_across_lines(spark):
    rows = [*WRAPPED, *ROWS[:14]]
    found = sorted(str(tuple(row)) for row in scan_windows(table(spark, rows, extra=("labels", "score"))).collect())
    assert found == sorted(str((doc, *run_by_run(text))) for doc, text in rows)
    assert [run_by_run(text)[0] for _, text in WRAPPED] == ["mit", "bsd", "mpl-2.0", "", "", "reserved", "", "", "", "cc-by-nc", "mit"]
    assert scan_windows(table(spark, rows).limit(0)).count() == 0
