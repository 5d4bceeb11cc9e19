"""Decontamination, license scan and source mixing against plain-Python versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from larder.llm import canonical
from larder.llm import decontaminate as dec
from larder.llm import licenses as lic
from larder.llm import mixing
from larder.llm.canonical import canonical_words
from larder.llm.queries import op3_decontamination, op5_license_scan, op7_source_mixing
from tests.conftest import SF_SMALL
from tests.llm import edge


# --- decontamination

def brute_leaks(rows, items, p=dec.DecontaminationParams()):
    """{(id, item)}: every window of every item against every window of every document, diagonal by diagonal."""
    def windows(text, size):
        w = canonical_words([(text or "").encode()])
        return w, list(zip(w.hashes.tolist(), w.kinds.tolist(), strict=True)), w.windows(size, p.min_literals)[0].tolist()

    found = set()
    for item, text in items:
        n = len((text or "").split())
        size = min(p.window, n)
        if item is None or not size:
            continue
        item_own, item_words, item_at = windows(text, size)
        for doc, body in rows:
            doc_own, doc_words, doc_at = windows(body, size)
            places = {}
            for a in doc_at:
                places.setdefault(tuple(doc_words[a:a + size]), []).append(a)
            diagonals = {}
            for b in item_at:
                for a in places.get(tuple(item_words[b:b + size]), ()):
                    pairs = list(zip(item_own.slots(b, size), doc_own.slots(a, size), strict=True))
                    diagonals.setdefault(a - b, []).append((b, pairs))
            for hits in diagonals.values():
                meaning = {}
                for _, pairs in hits:
                    for x, y in pairs:
                        meaning.setdefault(x, set()).add(y)
                covered = {w for b, pairs in hits if all(len(meaning[x]) == 1 for x, _ in pairs) for w in range(b, b + size)}
                if covered and (len(covered) >= p.share * n or len(covered) >= p.long_match):
                    found.add((doc, item))
    return found


ITEMS = [(1, "A train leaves Boston at 9 with 120 passengers and drops 45 of them after 30 minutes. How many of the 120 remain?"),
         (2, "Which planet of the solar system has the largest number of known moons today?"), (3, None), (4, ""), (5, "short one"),
         (None, "an item that has no number but many plain words in it"), (6, "only seven words are in this one")]
TRAIN = "A train leaves Denver at 7 with 250 passengers and drops 60 of them after 20 minutes. How many of the 250 remain?"
MIXED = "A train leaves Denver at 7 with 250 passengers and drops 60 of them after 20 minutes. How many of the 999 remain?"
LEAKY = [(1, "intro text here. " + ITEMS[0][1] + " outro"), (2, TRAIN), (3, "x " + MIXED), (4, "nothing to see here at all, just prose"),
         (5, "WHICH planet of the solar system has the largest number of known moons, says the book."), (6, None), (7, ""), (2, TRAIN),
         (8, "we know that only seven words are in this one and no more"), (9, "short one"), (10, "a b c " * 50_000 + ITEMS[1][1]),
         (None, TRAIN), (11, "Which planet of the solar system is yours?")]


def items_table(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id bigint, text string, words int")


def test_decontamination_edges(spark):
    docs = edge.documents(spark, [(i, t, "a") for i, t in LEAKY])
    got = dec.contaminated_pairs(docs, items_table(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute_leaks(LEAKY, ITEMS)
    by_doc = {(r["doc_id"], r["item_id"]): r for r in got}
    assert by_doc[1, 1]["changed_slots"] == 0 and by_doc[1, 1]["share"] == 1.0
    assert by_doc[2, 1]["changed_slots"] >= 4 and by_doc[2, 1]["covered"] == by_doc[2, 1]["item_words"]
    assert by_doc[3, 1]["covered"] < by_doc[2, 1]["covered"]        # 120 stands for both 250 and 999: inconsistent windows go
    assert (10, 2) in by_doc and (4, 1) not in by_doc


def test_decontamination_stage_keeps_clean_rows(spark):
    rows = [(i, t, "a") for i, t in LEAKY]
    docs = edge.documents(spark, rows)
    bad = {i for i, _ in brute_leaks(LEAKY, ITEMS)}
    out = dec.drop_contaminated(docs, items_table(spark))
    assert out.columns == docs.columns
    want = [(i, t) for i, t, _ in rows if i not in bad]
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)
    assert dec.drop_contaminated(docs, items_table(spark, [])).count() == len(rows)
    assert dec.drop_contaminated(edge.documents(spark, []), items_table(spark)).count() == 0


def pairs_of(spark, rows, items):
    docs = edge.documents(spark, [(i, t, "a") for i, t in rows])
    return {(r["doc_id"], r["item_id"]): r for r in dec.contaminated_pairs(docs, items_table(spark, items)).collect()}


def test_decontamination_finds_copies_of_items_with_few_literals(spark):
    items = [(1, "Where did Marie Curie die?"), (2, "Who wrote Hamlet and Macbeth?"), (3, "3 kg 5 kg 8 kg 13 kg 21 kg"),
             (4, "Sum of 4 8 15 16 23 42 108 and 7 is")]
    rows = [(i, f"some words before it. {t} And after") for i, t in items]
    rows += [(10 + i, f"a book that asks {t.lower()} in small letters") for i, t in items]
    rows += [(20, "Where did Anna Schmidt die?"), (21, "Who wrote Faust and Egmont?"), (22, "4 kg 6 kg 9 kg 14 kg 22 kg"),
             (23, "Where did Marie"), (24, "Sum of 5 9 16 17 24 43 109 and 8 is")]
    found = pairs_of(spark, rows, items)
    assert set(found) == {(i, i) for i, _ in items} | {(10 + i, i) for i, _ in items}
    assert all(r["share"] == 1.0 and r["changed_slots"] == 0 for r in found.values())


def test_decontamination_names_that_begin_sentences(spark):
    question = "{0} has 12 apples. {0} buys 5 pears. {0} eats 3 of them. How many are left?"
    wrapped = "A long walk took Peter and the dog to the village where Martha sold the last of her bread"
    items = [(1, question.format("Anna")), (2, wrapped)]

    def plain(text):            # every capitalised word a name, every number a number
        words = [w.strip(".?,") for w in text.split()]
        return ["#" if w.isdigit() else "@" if w[:1].isupper() and len(w) > 1 else w.lower() for w in words]

    rows = [(1, question.format("Carl")), (2, question.format("Anna").replace(".", "")), (3, wrapped.replace(" Martha", "\nMartha")),
            (4, wrapped.replace(" Peter", ".\nPeter")), (5, "Carl has 12 apples. Dora buys 5 pears. Egon eats 3 of them. So be it?"),
            (6, "Carl sells 9 plums. Carl eats 2 nuts now.")]
    want = {(i, k) for i, t in rows for k, item in items if plain(t) == plain(item)}
    assert want == {(1, 1), (2, 1), (3, 2), (4, 2)}
    found = pairs_of(spark, rows, items)
    assert set(found) == want and all(r["share"] == 1.0 for r in found.values())
    assert found[1, 1]["changed_slots"] == 1 and found[2, 1]["changed_slots"] == 0


def test_shared_openings_make_no_row_per_pair(spark):
    """40 items and 60 documents share eleven opening words; only documents that go on like an item match it."""
    opening = "please read the following story and then answer this question about"
    items = [(i, opening + "".join(f" word{i}x{k}" for k in range(14))) for i in range(40)]
    rows = [(i, opening + "".join(f" other{i}x{k}" for k in range(20))) for i in range(60)]
    rows += [(100 + i, items[i][1]) for i in range(5)]
    rows += [(200 + i, " ".join(items[i][1].split()[8:])) for i in range(5)]       # without a whole window of the opening
    rows += [(300, opening + "".join(f" word7x{k}" for k in range(1)) + " and then nothing")]      # 12 words: too few
    rows += [(301, opening + "".join(f" word7x{k}" for k in range(2)) + " and then nothing")]      # 13 words: enough
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), items_table(spark, items)
    windows = dec.with_seeds(dec.item_windows(table, dec.DecontaminationParams()), dec.DecontaminationParams())
    aside = {(r["item_id"], r["pos"]) for r in windows.where("NOT seed").collect()}
    assert aside == {(i, p) for i in range(40) for p in range(len(opening.split()) - 7)}
    got = {(r["doc_id"], r["item_id"]) for r in dec.contaminated_pairs(docs, table).collect()}
    assert got == brute_leaks(rows, items) and (301, 7) in got and (300, 7) not in got
    # items of few words: any window condemns, so none is set aside
    short = [(i, opening) for i in range(3)]
    windows = dec.with_seeds(dec.item_windows(items_table(spark, short), dec.DecontaminationParams()), dec.DecontaminationParams())
    assert windows.where("NOT seed").count() == 0
    got = {(r["doc_id"], r["item_id"]) for r in dec.contaminated_pairs(docs, items_table(spark, short)).collect()}
    assert got == brute_leaks(rows, short)


def test_decontamination_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(SF_SMALL + "/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(SF_SMALL + "/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in op3_decontamination(spark, SF_SMALL).collect()}
    assert got == brute_leaks(docs, items)
    verbatim = {(i, k) for i, t in docs for k, b in items if b in (t or "")}
    assert verbatim <= got


def test_canonical_words():
    text = 'The boy Tom ran 12 km. Anna ate three pies for $4.50\nNext “line” Élan ÉTÉ (Été) a I 3rd x1 -- $ "End." Then'
    w = canonical_words([text.encode()])
    shown = [w.raw[a:b].decode() for a, b in zip(w.first, w.last, strict=True)]
    assert shown[:12] == "The boy Tom ran 12 km Anna ate three pies for $4.50".split()
    assert w.kinds.tolist() == [0, 0, 3, 0, 1, 2, 0, 0, 1, 0, 0, 1, 0, 0, 3, 0, 3, 0, 0, 1, 0, 0, 2, 3, 0]
    assert w.hashes[0] == canonical_words([b"x THE"]).hashes[1] and shown[13] == "line"


def test_canonical_words_do_not_depend_on_slices_or_neighbours(monkeypatch):
    texts = [("Ab cd Ef. Gh ij\n" * 40 + "Kl mn 17 kg Op").encode(), b"", b"Qr Stu vw", "İx É".encode(), b"   \n"]
    alone = [canonical_words([t]) for t in texts]
    whole = canonical_words(texts)
    monkeypatch.setattr(canonical, "_SLICE", 50)
    sliced = canonical_words(texts)
    for w in (whole, sliced):
        for i, a in enumerate(alone):
            part = slice(w.bounds[i], w.bounds[i + 1])
            assert w.hashes[part].tolist() == a.hashes.tolist() and w.kinds[part].tolist() == a.kinds.tolist()
        at, wh = w.windows(3, 1)
        lone = [x for a in alone for x in a.windows(3, 1)[1].tolist()]
        assert wh.tolist() == lone


# --- license scan

def brute_licenses(rows, templates=lic.TEMPLATES, p=lic.LicenseParams()):
    """{(id, template): containment} over all windows, compared exactly."""
    found = {}
    for doc, text in rows:
        words = lic.words_in(text or "")
        for n, (_, notice, marks) in enumerate(templates):
            wanted = set(lic.shingles_in(lic.words_in(notice), p.shingle))
            length = len(lic.words_in(notice))
            stride = lic.stride_of(length)
            for start in range(0, len(words), stride):
                have = set(lic.shingles_in(words[start:start + length + stride - 1], p.shingle))
                share = len(wanted & have) / len(wanted)
                stated = all(any(f" {m} " in f" {s} " for s in wanted & have) for m in marks)
                if stated and share >= p.containment - 1e-9:
                    found[doc, n] = max(found.get((doc, n), 0), share)
    return found


LICENSED = [(1, "code. Released under the MIT License. more"), (2, lic.TEMPLATES[1][1].upper() + " and so on"), (3, None), (4, ""),
            (5, "lead " * 300 + lic.TEMPLATES[5][1].replace("redistribute", "share") + " tail " * 200),
            (6, "licensed under some terms of the license of the author"), (7, "All rights reserved."), (7, "All rights reserved."),
            (None, lic.TEMPLATES[7][1]), (8, "license " * 3000), (9, lic.TEMPLATES[3][1]), (10, "Ünder the MIT  License\nreleased"),
            (11, " ".join(lic.TEMPLATES[5][1].split()[::-1])), (12, "all rights"), (13, lic.TEMPLATES[12][1] * 3)]


def test_license_scan_edges(spark):
    got = lic.scan_licenses(edge.documents(spark, [(i, t, "a") for i, t in LICENSED])).collect()
    want = brute_licenses(LICENSED)
    assert {(r["doc_id"], r["template"]): round(r["containment"], 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert lic.scan_licenses(edge.documents(spark, [])).count() == 0


def test_every_version_of_a_family_is_told_apart(spark):
    rows = [(n, f"Some code stands here. {notice} And more of it follows there.", "a") for n, (_, notice, _) in enumerate(lic.TEMPLATES)]
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public " \
          "License as published by the Free Software Foundation; either version {} of the License, or any later version."
    unknown = ["GNU General Public License, version 1.", gpl.format(1), gpl.format(12), "Licensed under the Apache License, Version 1.1.",
               "Licensed under CC BY-SA 3.0.", "This work is licensed under a Creative Commons Attribution 3.0 International License.",
               "This work is licensed under a Creative Commons Attribution-NoDerivs 4.0 International License.",
               "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.0."]
    rows += [(100 + n, f"Some code. {text} The end.", "a") for n, text in enumerate(unknown)]
    rows += [(200, "Take it under the GNU General Public License, version 2. This work is licensed under the GNU General Public License, "
                   "version 2. Or else: this work is licensed under the GNU Affero General Public License, version 3.", "a")]
    names = {}
    for r in lic.scan_licenses(edge.documents(spark, rows)).collect():
        names.setdefault(r["doc_id"], set()).add(r["license"])
    assert names == {n: {name} for n, (name, _, _) in enumerate(lic.TEMPLATES)} | {200: {"GPL-2.0", "AGPL-3.0"}}
    with pytest.raises(ValueError, match="stands in no shingle"):
        lic.scan_licenses(edge.documents(spark, []), [("X", "Some notice of three words", ("version 2",))])


def test_license_scan_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(SF_SMALL + "/documents.parquet").select("doc_id", "text").collect()]
    got = {(r["doc_id"], r["template"]): round(r["containment"], 9) for r in op5_license_scan(spark, SF_SMALL).collect()}
    assert got == {k: round(v, 9) for k, v in brute_licenses(docs).items()}


def test_license_scan_runs_no_python(spark):
    plan = op5_license_scan(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_band_numbers_follow_from_the_bound():
    for _, notice, _ in lic.TEMPLATES:
        p, words = lic.LicenseParams(), lic.words_in(notice)
        j = lic.lowest_jaccard(len(words), p)
        bands = lic.bands_needed(j, p.rows, p.recall)
        assert 1 - (1 - j ** p.rows) ** bands >= p.recall - 1e-12
        anchors = lic.anchors_of(words, p)
        shingles = lic.shingles_in(words, p.shingle)
        free = [s for s in shingles if not anchors & set(s.split())]
        assert len(free) < p.containment * len(shingles)


# --- source mixing

def sources_of(spark, sizes):
    return spark.createDataFrame([(f"={n}", t) for n, t in enumerate(sizes)], "__src string, tokens bigint")


def entropy_at(sizes, exponent):
    total = sum(sizes)
    powers = [(t / total) ** exponent for t in sizes]
    w = [x / sum(powers) for x in powers]
    return -sum(x * math.log(x) for x in w), w


def test_bisection_meets_the_entropy_target(spark):
    sizes = [1000, 400, 90, 10]
    for target in (0.75, 0.9, 0.99):
        p = mixing.MixParams(entropy=target, max_epochs=1e9)
        e = mixing.bisect_exponent(sources_of(spark, sizes), sum(sizes), sum(sizes), 4, p)
        assert abs(entropy_at(sizes, e)[0] - target * math.log(4)) < 1e-6


def test_repetition_limit_raises_the_exponent(spark):
    sizes = [1000, 400, 90, 10]
    p = mixing.MixParams(entropy=0.999, max_epochs=3.0)
    e = mixing.bisect_exponent(sources_of(spark, sizes), sum(sizes), sum(sizes), 4, p)
    repeats = [w * sum(sizes) / t for w, t in zip(entropy_at(sizes, e)[1], sizes, strict=True)]
    assert abs(max(repeats) - 3.0) < 1e-4
    assert mixing.bisect_exponent(sources_of(spark, [5]), 5, 5, 1, p) == 1.0


@pytest.mark.parametrize("blocks", [1, 4, 64])
def test_budgets_are_met(spark, blocks):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["big"] * 12 + ["mid"] * 4 + ["small", None])) for i in range(600)]
    docs = edge.documents(spark, rows)
    p = mixing.MixParams(entropy=0.99, max_epochs=4.0, blocks=blocks)
    got = mixing.mixture(docs, p).collect()
    assert len(got) == len(rows)
    total = sum(len(t.split()) for _, t, _ in rows)
    sizes, read, weight, largest = {}, {}, {}, 0
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["n_tokens"]
        read[r["source"]] = read.get(r["source"], 0) + r["n_tokens"] * r["n_copies"]
        weight[r["source"]] = r["weight"]
        largest = max(largest, r["n_tokens"])
    assert abs(sum(weight.values()) - 1) < 1e-9
    for s, t in sizes.items():
        budget = weight[s] * total
        assert budget - largest - 1 <= read[s] <= budget + 1e-3
        copies = {r["n_copies"] for r in got if r["source"] == s and r["n_tokens"]}
        assert copies <= {math.floor(budget / t + 1e-9), math.floor(budget / t + 1e-9) + 1}


def test_mixing_edges(spark):
    docs = edge.documents(spark)
    got = mixing.mixture(docs, mixing.MixParams(blocks=8)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _, _ in edge.texts())
    out = mixing.mixed_documents(docs, mixing.MixParams(blocks=8))
    assert set(out.columns) == set(docs.columns) | {"mix_epoch", "mix_order"} and len(out.columns) == len(set(out.columns))
    copies = sum(r["n_copies"] for r in got)
    assert out.count() == copies
    assert mixing.mixture(edge.documents(spark, [])).count() == 0 and mixing.mixed_documents(edge.documents(spark, [])).count() == 0
    blank = edge.documents(spark, [(1, None, None), (2, " ", "a")])
    assert {r["n_copies"] for r in mixing.mixture(blank).collect()} == {0}


def test_mixing_whole_table(spark):
    df = op7_source_mixing(spark, SF_SMALL)
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet")
    assert df.count() == docs.count()
    row = df.agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("n_copies")).alias("r")).first()
    assert 0.8 * row["t"] <= row["r"] <= row["t"] + 1
    again = df.repartition(3).collect()
    assert sorted(map(str, again)) == sorted(map(str, df.collect()))


# --- order of the mixture

def test_documents_within_a_block_are_permuted(spark):
    docs = edge.documents(spark, [(i, f"text number {i} of some words", f"s{i % 2}") for i in range(600)])
    rows = mixing.mixed_documents(docs, mixing.MixParams(blocks=4, budget=12_000)).collect()
    places = [(r["mix_epoch"], r["mix_order"]) for r in rows]
    assert len(set(places)) == len(places) > 600
    in_order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["mix_epoch"], r["mix_order"])) if r["mix_epoch"] == 0]
    assert in_order != sorted(in_order) and len({o >> 36 for e, o in places if e == 0}) <= 8      # blocks stay together
    again = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["mix_epoch"], r["mix_order"])) if r["mix_epoch"] == 1]
    assert again != [i for i in in_order if i in set(again)]
