import re

import pytest

from millrace.llm import licenses as L


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(i, label) for phrase, label in L.BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


PLANTED = [
    "Code under the MIT-License. Under the mit license, again; CC BY-NC!",
    "apache license, VERSION 2 apache license version 2",
    "under themit license",
    "the mit license",
    "cc-by-nc-sa 4.0 and cc by nc",
]


def test_base_against_brute_force(spark, docs, texts):
    more = [(i, t) for i, t in enumerate(PLANTED, 20_000)]
    all_docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    out = L.license_scan(all_docs).collect()
    got = sorted(map(str, ((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out)))
    assert got == sorted(map(str, ((i, *brute(t)) for i, t in [*texts, *more])))
    for r in out:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"] == ",".join(sorted(filter(None, r["labels"].split(","))))


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3"),
        ("Licensed under the Apache License, Version 2.0", "apache-2"),
        ("Licensed under the Apache License, Version 1.1", "apache-1.1"),
        ("CC BY-NC-SA 4.0", "cc-by-nc,cc-by-nc-sa"),
        ("Creative Commons Attribution ShareAlike 4.0 International License", "cc-by-sa"),
        ("This is released under the BSD 3-Clause License.", "bsd-3"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
        ("All rights reserved.", "all-rights-reserved"),
        ("a poem about licence plates and apache helicopters", ""),
        ("mit dem Auto", ""),
        (None, ""),
    ],
)
def test_rules(spark, text, labels):
    out = L.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert out["labels"] == labels and (out["score"] > 0) == bool(labels)


def test_containment(spark):
    text = "x licensed under the apache license version 2 0 y under the terms of the gnu lesser general public license z"
    spans = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]["spans"]
    kept = {(s["start"], -s["back"], s["label"]) for s in spans}
    assert (1, 9, "apache-2") in kept
    assert not any(a < s and e <= b and p >= q for s, e, p in ((x["start"], -x["back"], x["priority"]) for x in spans) for a, b, q in ((x["start"], -x["back"], x["priority"]) for x in spans) if (a, b) != (s, e))


def test_many_detections_and_empty(spark, nothing):
    text = "under the mit license " * 3000
    out = L.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert (out["n_base"], out["first_word"], out["last_word"], out["labels"]) == (3000, 0, 11_996, "mit")
    assert L.license_scan(nothing).count() == 0 and len(L.rules()) >= 300


def test_anchors_cover_keywords():
    """Every base phrase and every passage passes the gate in any case and with any gaps."""
    gate = re.compile(L.ANCHORS)
    for phrase in L.BASE:
        assert gate.search(phrase.upper().replace(" ", "-"))
    for r in L.rules():
        example = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)", r"\1", re.sub(r"\(\?: [^()]*\)\?", "", r.pattern.replace("(?= )", "")))
        example = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", example).replace("licen[cs]e", "license").replace("unauthori[sz]ed", "unauthorized")
        if "\\" not in example and ".{" not in example:
            assert gate.search(example), (r.label, r.pattern)


def spelled(pattern):
    """Every text that an expression matches; open repeats once, with one word."""
    options, at = [[""]], 0
    pattern = re.sub(r"\.\{[\d,]+\}\??", "some", pattern)
    while at < len(pattern):
        c = pattern[at]
        if c == "|":
            options.append([""])
            at += 1
            continue
        if pattern.startswith("(?:", at):
            depth, end = 1, at + 3
            while depth:
                depth += {"(": 1, ")": -1}.get(pattern[end], 0)
                end += 1
            parts = spelled(pattern[at + 3 : end - 1])
        elif c == "[":
            end = pattern.index("]", at) + 1
            inner = pattern[at + 1 : end - 1]
            parts = [chr(x) for x in range(ord(inner[0]), ord(inner[2]) + 1)] if "-" in inner else list(inner)
        else:
            end, parts = at + 1, [c]
        if pattern[end : end + 1] == "?":
            end, parts = end + 1, ["", *parts]
        options[-1] = [a + b for a in options[-1] for b in parts]
        at = end
    return [x for o in options for x in o]


def test_keywords_cover_every_alternative():
    """Whatever text a rule matches holds one of its keywords as a word."""
    for _, keywords, names in L.FAMILIES:
        for name in spelled(names):
            assert set(keywords.split("|")) & set(name.split()), (name, keywords)
    for r in L.rules()[: -len(L.FAMILIES) * len(L.TEMPLATES)]:
        for example in spelled(r.pattern.replace("(?= )", "")):
            assert set(r.keywords.split("|")) & set(example.split()), (example, r.keywords)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the GPLv3", "gpl-3"),
        ("the GPL2 license", "gpl-2"),
        ("LGPLv2.1 license", "lgpl-2.1"),
        ("AGPLv3 license", "agpl-3"),
        ("MPLv2 license", "mpl-2"),
        ("under the terms of the Expat License", "mit"),
        ("the ASL 2.0 license", "apache-2"),
        ("Berkeley Software Distribution license", "bsd"),
        ("Internet Systems Consortium license", "isc"),
        ("BSL 1.0 license", "boost"),
        ("the PSF license", "python"),
        ("the beer-ware license", "beerware"),
        ("GNU FDL license", "gfdl"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose", "isc"),
    ],
)
def test_names_without_the_family_word(spark, text, labels):
    out = L.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert out["labels"] == labels and out["score"] > 0


def test_anchors_cover_every_alternative():
    gate = re.compile(L.ANCHORS)
    whole = L.rules()[: -len(L.FAMILIES) * len(L.TEMPLATES)]
    for pattern in [*(r.pattern for r in whole), *(t.format(n="name") for _, t in L.TEMPLATES)]:
        for example in spelled(pattern.replace("(?= )", "")):
            assert gate.search(example.upper().replace(" ", "-")) and gate.search(example + " "), example


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under MIT.", "mit"),
        ("Distributed under Apache 2.0.", "apache-2"),
        ("available under GPL version 3", "gpl-3"),
        ("you can redistribute it under terms of BSD", "bsd"),
        ("offered to you under ISC", "isc"),
    ],
)
def test_use_without_the_word_license(spark, text, labels):
    out = L.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert out["labels"] == labels and out["score"] > 0
