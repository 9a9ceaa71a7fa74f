"""Text operators against brute force, with nulls, empty and long texts, ties, repeats and no rows."""

import base64
import hashlib
import random
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadvane.llm import bpe, jaccard, licenses, mixing, sharding, tokenfile, toxicity
from loadvane.llm.common import octets

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "a", "a" * 3000, "The the THE", "né\u0301e ß 日本語 \U0001f600", "x\ty\nz", "<|endoftext|>", "!!!!" * 40]


def words(rng, n, size=40):
    return " ".join(rng.choice(["tok%d" % i for i in range(size)]) for _ in range(n))


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, docs, library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("abAB é,.\n0") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    texts.append("".join(rng.choice("eatinosrhl") for _ in range(4000)))
    df = docs([(i, t) for i, t in enumerate(texts)] + [(0, "again"), (None, "no id")])
    got = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    kept = df.select("doc_id", "text").collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, library.encode_ordinary(r.text or "")) for r in kept)
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids)) for r in got.collect()) == want
    assert all(bytes(r.decoded).decode() == library.decode(list(r.ids)) for r in got.collect())


def test_bpe_digest(spark, docs, library):
    row = bpe.digest(docs([(7, "Hello wörld")]), RANKS, public_tokenizers.PATTERN).first()
    ids = library.encode_ordinary("Hello wörld")
    assert (row.doc_id, row.n_tokens) == (7, len(ids))
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256("Hello wörld".encode()).hexdigest()
    assert bpe.digest(docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_files(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(3, "same id"), (None, "no id"), (-5, "Stop, it. don't it's U.S.A,. İx,")]
    files = tokenfile.write_tokens(docs(rows), path, 2, 4)
    got = tokenfile.read_tokens(spark, files).collect()
    want = sorted(
        (i is None, i or 0, b"".join(x.to_bytes(4, "little") for x in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]))
        for i, t in rows
    )
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in got) == want
    placed = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in placed] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i or 0))
    assert [r.start for r in placed] == [sum(len(x.ids) // 4 for x in placed[:k]) for k in range(len(placed))]
    some = tokenfile.read_tokens(spark, files, only=[9, -5, 1000]).collect()
    assert sorted(r.doc_id for r in some) == [-5, 9]
    assert tokenfile.read_tokens(spark, tokenfile.write_tokens(docs([]), path, 2, 4)).count() == 0


def test_damaged_token_file_is_an_error(tmp_path):
    import numpy as np
    from pyarrow import fs

    target = str(tmp_path / "f")
    with fs.LocalFileSystem().open_output_stream(target) as out:
        writer = tokenfile.FileWriter(out)
        writer.add(np.array([1]), np.array([False]), np.array([3]), np.array([5, 6, 2]))
        writer.close()
    raw = bytearray(open(target, "rb").read())
    with fs.LocalFileSystem().open_input_file(target) as source:
        frames, documents = tokenfile.read_table(source)
        assert len(documents) == 1 and zlib.crc32(tokenfile.read_frame(source, frames[0])) == frames[0]["crc"]
    raw[int(frames[0]["stored"]) + 2] ^= 1
    open(target, "wb").write(raw)
    with fs.LocalFileSystem().open_input_file(target) as source, pytest.raises(ValueError):
        tokenfile.read_table(source)


def test_mixing_meets_targets(spark, docs):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(0, 60)), rng.choice(["a", "a", "b", "c", None])) for i in range(600)]
    rows += [(1, "same id", "a"), (None, "no id", "b"), (None, None, "c")]
    df = docs(rows)
    weights = mixing.cyclic_weights(df.select("source").distinct(), (3, 1, 2))
    got = mixing.mix(df, weights, share=1.5, max_epochs=2.0)
    again = mixing.mix(df.repartition(3), weights, share=1.5, max_epochs=2.0)
    found = got.collect()
    assert len(found) == len(rows) and "KEY" in got.columns
    key = lambda r: (str(r.doc_id), str(r.text), r.repeats)
    assert sorted(map(key, found)) == sorted(map(key, again.collect()))
    total = sum(len((t or "").split()) for _, t, _ in rows)
    by = {r.source: (r.source_size, r.target) for r in found}
    assert sum(t for _, t in by.values()) == pytest.approx(1.5 * total)
    for source, (size, target) in by.items():
        taken = sum(r.size * r.repeats for r in found if r.source == source)
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= 3
    assert max(r.repeats for r in found) <= 2
    assert mixing.repeated(got).count() == sum(r.repeats for r in found)
    assert mixing.mix(docs([]), weights).count() == 0


def test_water_filling_is_the_fixed_point(spark):
    sizes = spark.createDataFrame([("a", 10, 3.0), ("b", 100, 1.0), ("c", 40, 2.0)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.water_fill(sizes, 1.5, 2.0).collect()}
    # 225 in all: a stops at 20, c at 80, b takes the other 125
    assert got == {"a": 20.0, "b": 125.0, "c": 80.0}


def test_sharding_law(spark, docs):
    rng = random.Random(3)
    rows = [(i, words(rng, rng.randint(0, 80))) for i in range(1500)] + [(5000 + i, "copy copy") for i in range(30)]
    rows += [(9000, None), (9001, ""), (9002, "x" * 500), (3, "same id"), (None, "no id")]
    text = F.coalesce("text", F.lit(""))
    make = lambda df: sharding.shard(
        df, {"size": F.log2(octets(text) + 1), "script": F.length(text)}, octets(text) + 16, F.xxhash64(text), 7, {"doc_id": F.col("doc_id"), "t": text}
    )
    got = make(docs(rows)).collect()
    assert len(got) == len(rows)
    held = {s: [r for r in got if r.shard == s] for s in range(7)}
    load = [sum(r.size for r in part) for part in held.values()]
    assert max(load) < 1.05 * sum(load) / 7
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in held.values())
    shards = {}
    for r in got:
        shards.setdefault(r.t, set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    assert make(docs([])).count() == 0


def test_a_group_above_a_shard_is_split(spark, docs):
    rows = [(i, "many copies of one text") for i in range(400)] + [(1000 + i, f"other {i}") for i in range(100)]
    got = sharding.shard(docs(rows), {"size": octets(F.col("text"))}, octets(F.col("text")) + 16, F.xxhash64("text"), 5, {"doc_id": F.col("doc_id")}).collect()
    load = [sum(r.size for r in got if r.shard == s) for s in range(5)]
    assert max(load) < 1.15 * sum(load) / 5


def test_license_scan(spark, docs):
    rows = [
        (1, "Text CC BY here. cc-by again. All rights reserved"),
        (2, "Licensed under the Apache License, Version 2.0"),
        (3, "This work is now licensed under the GNU General Public License, version 3"),
        (4, "cc and by apart; general public"),
        (5, None),
        (6, ""),
        (7, "word " * 5000 + "General Public License"),
        (7, "cc by"),
    ]
    got = licenses.scan(docs(rows), licenses.PHRASES, licenses.NOTICES)
    by = {(r.doc_id, r.n_words): r for r in got.collect()}
    assert len(by) == len(rows)
    r = by[1, 10]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.score) == (3, 1, 7, "cc-by,reserved", 1.0)
    assert by[2, 8].labels == "apache-2.0" and by[2, 8].n_base == 0 and by[2, 8].first_word is None
    # a word put in moves the rest of the notice to the next diagonal
    assert by[3, 13].labels == "gpl,gpl-3.0" and by[3, 13].base_labels == "gpl"
    assert by[4, 6].labels == "" and by[4, 6].score == 0.0
    assert by[5, 0].labels == by[6, 0].labels == ""
    assert (by[7, 5003].first_word, by[7, 2].n_base) == (5000, 1)
    assert licenses.scan(docs([]), licenses.PHRASES, licenses.NOTICES).count() == 0


def brute_links(texts):
    sets = {}
    for t in texts:
        w = (t or "").split()
        sets[t] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    keys = [t for t in sets if sets[t]]
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}


def test_every_license_line_of_the_tables_is_labelled(spark, docs):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "All rights reserved.": "reserved",
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Released under the old bridge by the mit": "",
    }
    rows = [(i, f"Some words before.\n{line}\nAnd some after it.") for i, line in enumerate(lines)]
    got = {r.doc_id: r.labels for r in licenses.scan(docs(rows), licenses.PHRASES, licenses.NOTICES).collect()}
    assert [got[i] for i in range(len(lines))] == list(lines.values())


def test_jaccard_join_equals_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 6)  # so that splitting and blocks are reached
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    rng = random.Random(4)
    base = [words(rng, n, 300) for n in (3, 8, 40, 60, 200, 400)]
    passage = words(rng, 60, 300)
    rows = [t for t in base for _ in range(2)]
    for t in base[2:]:
        for _ in range(25):
            w = t.split()
            w[rng.randrange(len(w))] = "changed%d" % rng.randrange(5)
            rows.append(" ".join(w))
    rows += [words(rng, 50, 300) + " " + passage + " " + words(rng, 50, 300) for _ in range(30)]
    rows += [None, "", "  ", "short", "short", "x " * 3000]
    table = [(i, t) for i, t in enumerate(rows)]
    got = {r.doc_id: r for r in jaccard.near_duplicates(docs(table)).collect()}
    links = brute_links(rows)
    assert len(got) == len(rows) and len(links) > 100
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    worded = [i for i, t in table if t and t.split()]
    for i in worded:
        for j in worded:
            if j < i and (rows[i] == rows[j] or (rows[i], rows[j]) in links or (rows[j], rows[i]) in links):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    for i, t in table:
        assert got[i].n_links == sum(t in pair for pair in links)
        assert got[i].class_id == find(i)
    kept = jaccard.keep_one(docs(table + [(0, rows[0])]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(i) for i, _ in table})
    assert kept.columns == ["doc_id", "text", "source", "KEY"]
    assert jaccard.near_duplicates(docs([])).count() == 0


def test_kernel_tolerates_gaps():
    words_of = toxicity.Words(["\x02stupid\x03"])
    same, gapped, other, part = words_of.measure(["stupid", "stu-pid", "sunrise", "stupidly"])[:, 0]
    assert same == pytest.approx(1) and 0.3 < gapped < 1 and other == 0 and part > 0.4
    spelled, of = words_of.sentences(["you s t u p i d one", "nothing"])
    assert spelled[:, 0].max() > 0.9 and list(of) == [0]


def test_toxicity_learns_and_scores(spark, docs):
    rng = random.Random(5)
    insults = ["grobnik", "blatherskite"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = ". ".join(words(rng, 8) for _ in range(3))
        rows.append((i, text + (f" {rng.choice(insults)}" if toxic else "") + " end."))
        labels.append((i, int(toxic)))
    table = docs(rows + [(900, None), (901, ""), (902, "z" * 50_000), (903, "you grob-nik")])
    known = spark.createDataFrame([*labels, (950, None), (None, 1)], "id long, toxic int")
    model = toxicity.train(table, known.where("id % 8 != 4 or id is null"))
    got = {r.doc_id: r.score for r in toxicity.score(table, model, {"doc_id": F.col("doc_id")}).collect()}
    assert len(got) == 404 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.3) == bool(t) for i, t in labels)
    assert got[900] == got[901] < 0.3 and got[902] < 0.3 and got[903] > got[900]
    empty = toxicity.train(table, known.limit(0))
    assert {r.score for r in toxicity.score(table, empty, {"doc_id": F.col("doc_id")}).collect()} == {0.5}


def test_a_bucket_that_does_not_shrink_is_split_but_once(docs, monkeypatch):
    stored, wide = jaccard.store, []

    def counted(df, label):
        out = stored(df, label)
        if label == "near-level":
            wide.append(out.where(F.col("held") > jaccard.SMALL).count())
        return out

    monkeypatch.setattr(jaccard, "store", counted)
    line = " ".join(f"line{i}" for i in range(30))
    own = [" ".join(f"own{k}x{i}" for i in range(60)) for k in range(70)]
    rows = [(k, f"{line} {text}") for k, text in enumerate(own)] + [(70, f"{line} {own[7]} more")]
    found = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_duplicates(docs(rows)).collect()}
    assert found == {k: (k, 0) for k in range(70)} | {7: (7, 1), 70: (7, 1)}
    # the shared line makes the same bucket again and again, which is one at every level
    assert wide[0] > 0 and max(wide) <= 2 * len(rows)


def test_token_encoder_parts_letters_from_signs_in_slices(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(5)
    marks = ["a,", "A.", "b.)", "Ünï,", "É", "don't.", "x1,y", "ß.", "İ", "Σς,", "é.", "K,", "..", " ", "\n", "\t"]
    texts = [*(t or "" for t in ODD), *("".join(rng.choices([*marks, " ", "Word", "word,"], k=30)) for _ in range(200))]
    plain = Tokenizer.from_file(path)
    encoder = tokenfile.Encoder(path)
    monkeypatch.setattr(tokenfile, "REMEMBERED", 50)
    for first in range(0, len(texts), 17):
        ids, counts = encoder.encode(pa.array(texts).slice(first, 17))
        wanted = [plain.encode(t, add_special_tokens=False).ids for t in texts[first : first + 17]]
        assert counts.tolist() == [len(x) for x in wanted]
        assert ids.tolist() == [i for x in wanted for i in x]
    # forms that differ in case or in a sign behind are one piece
    encoder._forget()
    encoder.encode(pa.array(["Table table, TABLE. table"]))
    assert set(encoder.numbers) == {"table", ",", "."}


def test_likeness_of_a_bucket_takes_no_row_per_token(spark, monkeypatch):
    rng = random.Random(6)
    common = rng.sample(range(-(2**31), 2**31), 32)
    own = [rng.sample(range(-(2**31), 2**31), 32) for _ in range(200)]
    # sets of path 1 are the same, those of 2 differ, those of 3 share a quarter, those of 4 have one token
    heads = {1: [common] * 200, 2: own, 3: [common[:4] + x[4:] for x in own], 4: [[7]] * 200}
    rows = [(path, len(sets), sets_head) for path, sets in heads.items() for sets_head in sets]
    df = spark.createDataFrame(rows, "path long, held long, head array<int>").repartition(5)
    made, signed = [], jaccard._signed

    def counted(rows):
        out = signed(rows)
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_signed", counted)
    alike = jaccard._alike(df)
    assert sorted(r.path for r in alike.collect()) == [1, 4]
    # a row per bucket and batch, not per set or token
    assert made[0] <= 4 * 5
    assert "Generate" not in alike._jdf.queryExecution().toString()
    assert jaccard._alike(df.where("path < 0")).count() == 0
