"""Secret ledger, periodic runs and tokenizer alignment against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadvane.llm import alignment, periodic, queries, secretledger
from loadvane.llm.alignment import Files, Fragment, ranges, tokenizers
from loadvane.session import fresh_dir

EITHER = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(rf"""({EITHER}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
SHAPES = (("assign", ASSIGN, 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24))


def base_spans(text):
    """(start, place of the kind, end) of every base finding, straight from the patterns."""
    return sorted(
        (m.start(), k, m.end())
        for k, (_, pattern, group, least) in enumerate(SHAPES)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    )


def written_spans(spans):
    return ",".join(f"{SHAPES[k][0]}:{a}:{b}" for a, k, b in spans)


def texts_with_secrets(rng, n):
    bits = ["password", "PassWd", "SECRET", "token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "abc", "abcdef1",
            "AKIA" + "A" * 15, "AKIA" + "B7" * 9, "0a" * 11, "deadbeef" * 3, "f" * 60, "ſecret=abcdefgh", "é", "\n", "toKen=x=yz"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture
def written(spark, tmp_path):
    """A folder with a documents table of (doc_id, text) rows and a column that clashes."""

    def make(rows):
        df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, `SPANS` string")
        df.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return make


def test_secrets_equal_brute_force(spark, written):
    rng = random.Random(5)
    rows = list(enumerate(texts_with_secrets(rng, 250)))
    rows += [(900, None), (901, ""), (None, "token=abcdefg"), (902, "x" * 200_000 + " secret: hunter22"), (5, "token=abcdefg"), (5, "token=abcdefg")]
    got = queries.op11_secret_ledger(spark, written(rows)).collect()
    want = []
    for doc_id, text in rows:
        spans = base_spans(text)
        kinds = Counter(k for _, k, _ in spans)
        want.append((str(doc_id), kinds[0], kinds[1], kinds[2], hashlib.sha256(written_spans(spans).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == sorted(want)
    # the method's own spans come on top; the base ones stay in place
    of_base = ("assign:", "access:", "hex:")
    for r in got:
        kept = ",".join(s for s in r.spans.split(",") if s.startswith(of_base))
        assert hashlib.sha256(kept.encode()).hexdigest() == r.base_sha256
    assert queries.op11_secret_ledger(spark, written([])).count() == 0


def test_added_forms(spark, docs):
    text = "see ghp_" + "a1" * 20 + " and ftp://me:hunter22@host, -----BEGIN RSA PRIVATE KEY-----"
    rows = secretledger.scan(docs([(1, text)]), secretledger.FORMS, fresh_dir(spark, "ledger"), ["doc_id"]).first()
    assert [f.kind for f in rows.findings] == ["hosted_git", "url_login", "private_key"]


def test_ledger_scans_only_what_it_lacks(spark, docs):
    ledger = fresh_dir(spark, "ledger")
    rules = [secretledger.Rule("digits", "[0-9]+", 2)]
    history = [("a.txt", 1, "x 12"), ("b.txt", 1, "x 12"), ("a.txt", 2, "none"), ("c.txt", 1, None)]

    def scan(rows, rules):
        df = spark.createDataFrame(rows, "path string, version int, text string")
        found = secretledger.scan(df, rules, ledger, ["path", "version"]).collect()
        return {(r.path, r.version): [(f.kind, f.begin, f.end) for f in r.findings] for r in found}

    def scans():
        return spark.read.schema(secretledger.LEDGER).parquet(ledger).select("blob", F.explode("rules")).count()

    hit = [("digits", 2, 4)]
    assert scan(history, rules) == {("a.txt", 1): hit, ("b.txt", 1): hit, ("a.txt", 2): [], ("c.txt", 1): []}
    assert scans() == 3  # two equal contents are one blob, and the one without findings is noted
    history += [("a.txt", 3, "x 12"), ("d.txt", 1, "77")]
    assert scan(history, rules)[("a.txt", 3)] == hit
    assert scans() == 4  # a restored content is not scanned again
    more = [*rules, secretledger.Rule("letters", "x", version=3)]
    assert scan(history, more)[("b.txt", 1)] == [("letters", 0, 1), ("digits", 2, 4)]
    assert scans() == 8  # only the new rule ran, once a blob
    changed = [secretledger.Rule("digits", "[0-9]", 1, version=2)]
    assert scan(history, changed)[("b.txt", 1)] == [("digits", 2, 3), ("digits", 3, 4)]
    assert scans() == 12
    with pytest.raises(ValueError):
        secretledger.record(spark.createDataFrame(history, "path string, version int, text string"), [*rules, *rules], ledger)


def all_runs(words, least=24, times=3):
    """Every (start, length, period) by comparing all places for all periods."""
    found = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, times * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def test_difference_cover_extensions():
    assert sorted({(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER}) == list(range(periodic.MODULUS))
    rng = np.random.default_rng(2)
    for kinds in (1, 2, 30):
        words = np.r_[rng.integers(0, kinds, 150), np.tile(rng.integers(0, kinds, 9), 20)]
        index = periodic.Extensions(words)
        left, right = rng.integers(0, len(words), (2, 500))
        left, right = left[left != right], right[left != right]
        want = []
        for i, j in zip(left.tolist(), right.tolist()):
            n = 0
            while max(i, j) + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            want.append(n)
        assert index.common(left, right).tolist() == want


def test_runs_equal_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        texts = []
        for _ in range(rng.integers(1, 6)):
            words = rng.integers(0, rng.integers(1, 5), rng.integers(0, 260))
            if rng.random() < 0.6 and len(words):
                words = words[periodic.repeated_tail(int(rng.integers(0, 10**6)), len(words))]
            texts.append(words)
        rows = periodic.find_runs(np.concatenate(texts), np.array([len(t) for t in texts]))
        for number, words in enumerate(texts):
            assert [tuple(r[1:]) for r in rows[rows[:, 0] == number].tolist()] == all_runs(words.tolist())


def test_periodic_query_equals_brute_force(spark, written):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("ab cd é x".split(" ")) for _ in range(rng.randint(0, 150)))) for i in range(150)]
    rows += [(900, None), (901, ""), (None, "a " * 50), (902, "\t\n"), (903, "w " * 20_000), (904, "q " + "a b " * 20 + "c d e " * 15 + "c x"), (7, "a b c " * 30), (7, "a b c " * 30)]
    got = queries.op12_periodic_runs(spark, written(rows)).collect()
    want = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = all_runs(words) if len(set(words)) > 1 or n < 1000 else [(0, n, 1)]
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        found = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        want.append((doc_id, len(runs), *found, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept))))
    assert any(r[1] > 1 for r in want)
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert queries.op12_periodic_runs(spark, written([])).count() == 0


FILES = Files(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
ODD_TEXTS = [None, "", " ", "  a  b ", "a▁b", "<s> <|endoftext|> <0x41>", "日本語 é ﬁ ① 🙂\n\tx\x00", "the the the", "z" * 3000, " " * 2500 + "q"]


def by_definition(text):
    """n_a, n_b, groups and the counted links of a text, all pairs of tokens compared; None without tokens."""
    if not text:
        return None
    known, raw = tokenizers(FILES), (" " + text).encode()
    sides = []
    ids_a = known.own.encode(" " + text, add_special_tokens=False).ids
    for ids, of in ((ids_a, known.a), (known.model.encode(text), known.b)):
        ends = np.cumsum(of.sizes[ids]).tolist()
        if of.spell(np.array(ids)).tobytes() != raw:
            return None
        sides.append(list(zip([0, *ends], ends, ids)))
    a, b = sides
    groups, low = [], 0
    for cut in sorted({x[1] for x in a} & {x[1] for x in b}):
        groups.append("|".join(",".join(str(i) for _, e, i in side if low < e <= cut) for side in sides))
        low = cut
    links, first = Counter(), 0
    for s, e, i in a:
        while b[first][1] <= s:
            first += 1
        for s2, e2, j in b[first:]:
            if s2 >= e:
                break
            links[j, i] += 1
    return len(a), len(b), ";".join(groups), links


def random_texts(rng, n):
    parts = list("abcdeé ñ  \n.,'\"01日🙂ß") + ["the ", "ing ", " and"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 300))) for _ in range(n)]


def test_fragments_compose_in_any_tree():
    rng, known = random.Random(8), tokenizers(FILES)
    for text in random_texts(rng, 60) + [t for t in ODD_TEXTS if t]:
        want, raw = by_definition(text), b" " + text.encode()
        for length in (7, 40, 1000):
            parts = []
            for low, high, begin, end in ranges(raw, length):
                a, b, good = alignment._encoded(raw[begin:end], begin, known)
                parts.append(Fragment.of(a.part(low or None, high), b.part(low or None, high), known, spoiled=not good))
            parts.insert(rng.randrange(len(parts) + 1), Fragment())  # changes nothing
            while len(parts) > 1:
                at = rng.randrange(len(parts) - 1)
                parts[at : at + 2] = [parts[at].then(parts[at + 1], known)]
            whole = parts[0].whole(known)
            if want is None:
                assert (whole.n_a, whole.n_links, whole.text, len(whole.keys)) == (0, 0, "", 0)
            else:
                found = {(k >> 32, k & 0xFFFFFFFF): n for k, n in zip(whole.keys.tolist(), whole.times.tolist())}
                assert (whole.n_a, whole.n_b, whole.text[:-1], found) == want[:3] + (dict(want[3]),)


def test_ranges_cover_every_byte_once():
    for raw in (b" " + b"ab cd " * 40, b" " + b"x" * 500, b" " + b"a  b  " * 50, b" "):
        cut = ranges(raw, 32)
        assert [r[0] for r in cut] == [0, *(r[1] for r in cut[:-1])] and cut[-1][1] == len(raw)
        assert all(r[2] <= r[0] and r[1] <= r[3] for r in cut)
    assert len(ranges(b" " + b"x" * 500, 32)) == 1


@pytest.mark.parametrize("length", [alignment.RANGE, 200])
def test_alignment_equals_the_definition(spark, docs, length):
    rng = random.Random(9)
    rows = list(enumerate(random_texts(rng, 50) + ODD_TEXTS)) + [(3, "the the the"), (None, "no id"), (61, " ".join(random_texts(rng, 12)))]
    found = [by_definition(t) for _, t in rows]
    count = sum((f[3] for f in found if f), Counter())
    top = {b: max(n for (x, _), n in count.items() if x == b) for b, _ in count}
    want = []
    for (doc_id, _), f in zip(rows, found):
        n_a, n_b, groups, links = f or (0, 0, "", Counter())
        best = sum(n for k, n in links.items() if count[k] == top[k[0]])
        sums = (len(groups.split(";")) if f else 0, links.total(), best, sum(n * count[k] for k, n in links.items()))
        want.append((doc_id, n_a, n_b, *sums, groups, hashlib.sha256(groups.encode()).hexdigest() if f else ""))
    got = alignment.align(docs(rows), FILES, keep_groups=True, length=length)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_alignment_of_no_rows(spark, docs):
    assert alignment.align(docs([]), FILES).count() == 0
    empty = alignment.align(docs([(1, None), (2, "")]), FILES).collect()
    assert all(r.n_a == r.n_links == r.count_sum == 0 and r.groups_sha256 == "" for r in empty) and len(empty) == 2
    assert alignment.align(docs([]), FILES).schema["count_sum"].dataType == T.LongType()


def test_grid_of_periods_is_probed_in_bounded_memory():
    rng = np.random.default_rng(8)
    size = np.full(40, 5_000)
    words = rng.integers(0, 30_000, size.sum())
    words[7_000:7_900] = np.tile(words[7_000:7_300], 3)
    tracemalloc.start()
    found = periodic.find_runs(words, size)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [1, 2_000, 900, 300] in found.tolist()
    # about ten numbers per grid point at once, of a part of the points
    assert peak < 60e6
