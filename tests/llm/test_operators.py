"""Each operator against a plain brute-force version, and its special cases."""

from __future__ import annotations

import hashlib
import os
import random
import re
import struct
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from stopclock.llm import (
    bpe,
    decontaminate,
    graph,
    pii,
    prefix_hash,
    quality_gam,
    queries,
    secret_lexer,
    simhash,
    spans,
    suffix_dedup,
    token_files,
    url_rules,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = public_tokenizers.path("byte_bpe_50k.json")
ROOT = Path(__file__).parents[2]
SCHEMA = "doc_id bigint, text string, key string, ids string, part int"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(60)) for _ in range(n))


ODD_TEXTS = [
    None,
    "",
    " ",
    "a",
    "It's  a\n\ntest, don't: 12³ naïve 'll ''re 　x  😀!",
    prose(1, 60),
    prose(1, 60),
    prose(2, 30000),
    "aaaa " * 300,
    "\n" * 50,
]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "x", "y", 3) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing column names."""
    ids = [*range(len(ODD_TEXTS) - 1), None]
    return frame(spark, ODD_TEXTS, ids).union(frame(spark, [ODD_TEXTS[4]], [4])).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def expected_rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def test_pretokens_and_ids_are_those_of_the_library():
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )
    rnd = random.Random(5)
    alphabet = "abstmdrvel'' \n\t  !1.é　 ²Ⅷ中😀́"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    texts += ["ab" * 3000 + "xyz" * 500, " " * 5000, "", "'s't're"]
    ids, starts = bpe.encode_texts(texts, bpe.rank_table(RANKS))
    for text, own, at in zip(texts, ids.to_pylist(), starts.to_pylist(), strict=True):
        assert own == library.encode_ordinary(text), text
        assert at == sorted(set(at)) and (not text or at[0] == 0)


def test_encode_and_decode(odd, empty):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )
    out = bpe.decode(bpe.encode(odd, RANKS), RANKS, keep=("doc_id", "ids")).collect()
    want = Counter((i, tuple(library.encode_ordinary(t)), t.encode()) for i, t in expected_rows(odd))
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in out) == want
    assert bpe.decode(bpe.encode(empty, RANKS), RANKS).count() == 0


def test_token_cache_forgets_and_still_answers():
    calls = []
    cache = bpe.Cache(lambda ts: (calls.extend(ts), [[len(t)] for t in ts])[1], size=4)
    for t in ["a", "bb", "ccc", "dddd", "eeeee", "a", "bb"] * 3:
        assert np.frombuffer(cache.look_up([t])[0], "<i4").tolist() == [len(t)]
    assert len(cache.young) <= 4 and len(calls) >= 5


def test_token_files_keep_order_and_starts(spark, odd, empty, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write(odd, path, LIBRARY, end_id=2, parts=4)
    tokenizer = Tokenizer.from_file(LIBRARY)
    start, want = 0, []
    for i, t in sorted(expected_rows(odd), key=lambda r: (r[0] is not None, r[0], r[1])):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    got = [tuple(r) for r in token_files.index(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert [r["doc_id"] for r in token_files.find(spark, path, 5).collect()] == [5]
    token_files.write(empty, str(tmp_path / "none"), LIBRARY, end_id=2)
    assert token_files.index(spark, str(tmp_path / "none")).count() == 0


def test_token_files_know_the_added_tokens():
    tokenizer = Tokenizer.from_file(LIBRARY)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"x{end}", f"{end} y", "plain  text", "", f"<|{end}|>{end[:-1]}", f"é\n {end}\n\n{end}'s"]
    for some in (texts, texts[::-1], texts[5:7], [*texts * 20]):
        assert token_files._encode(some, LIBRARY).to_pylist() == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def test_token_files_solve_many_pretokens_at_once():
    tokenizer = Tokenizer.from_file(LIBRARY)
    rnd = random.Random(9)
    alphabet = "abstmdrvel'' \n\t  !1.é　 ²Ⅷ中😀́\r\x1c\x85\u2028\xa0\0"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    texts += ["'s", " 's", " ", "\n", " \n a", "a" * 5000, " " * 300 + "x", ""]
    got = token_files._encode(texts, LIBRARY).to_pylist()
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files_start_no_threads_in_a_task():
    code = """
import os, sys
from stopclock.llm import token_files
token_files._library_table(sys.argv[1])
before = len(os.listdir("/proc/self/task"))
token_files._encode([f"word{i} and{i}" for i in range(9000)], sys.argv[1])
assert len(os.listdir("/proc/self/task")) == before
"""
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")}
    subprocess.run([sys.executable, "-c", code, LIBRARY], env=env, cwd=ROOT, check=True, timeout=120)


def test_token_files_write_added_tokens(spark, tmp_path):
    path, texts = str(tmp_path / "ids"), ["a <|endoftext|> b", "c", None]
    token_files.write(frame(spark, texts), path, LIBRARY, end_id=2, parts=2)
    tokenizer = Tokenizer.from_file(LIBRARY)
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["ids"] for r in token_files.read(spark, path).collect()} == want and 50256 in want[0]


def test_longest_common_extension_and_edited_prefix():
    rnd = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rnd.choice("ab") for _ in range(rnd.randrange(30))) for _ in range(2))
        p, q = prefix_hash.Prefix(a), prefix_hash.Prefix(b)
        i, j = rnd.randrange(len(a) + 1), rnd.randrange(len(b) + 1)
        want = 0
        while i + want < len(a) and j + want < len(b) and a[i + want] == b[j + want]:
            want += 1
        assert p.extension(i, q, j) == want
        both = prefix_hash.Prefix.edited(p, q)
        assert prefix_hash.fingerprint_of(both) == prefix_hash.fingerprint(prefix_hash.edited(a, b))


def test_compare_with_next(odd, empty):
    out = prefix_hash.compare_with_next(odd).collect()
    rows = sorted(expected_rows(odd), key=lambda r: (r[0] is not None, r[0], r[1]))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        want[i, len(t), t[: len(t) - len(t) // 2] + following[: len(t) // 2]] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_text"]) for r in out) == want
    for r in out:
        assert 0 <= r["near_next"] <= 1 and r["near_edited"] >= 0.45
    assert prefix_hash.compare_with_next(empty).count() == 0
    assert prefix_hash.likeness(prefix_hash.fingerprint(""), prefix_hash.fingerprint("")) == 1
    moved = prefix_hash.fingerprint("x" + prose(3, 80))
    assert prefix_hash.likeness(prefix_hash.fingerprint(prose(3, 80)), moved) > 0.9


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m[0])) <= 15),
]
SECRETS = [
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def plain_spans(text, kinds):
    found = [(m.start(), i, m.end(), k) for i, (k, p, ok) in enumerate(kinds) for m in re.finditer(p, text, re.A) if ok(m)]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_base_spans_match_the_open_patterns():
    rnd = random.Random(3)
    for _ in range(4000):
        text = "".join(rnd.choice("a1.@-+ ()5%_ü7.4") for _ in range(rnd.randrange(60)))
        assert spans.joined(pii.base_spans(text), pii.KINDS) == plain_spans(text, PII), text
    parts = "token secret api_key PassWord AKIA = : ' \" abc AB12CD34EF56 9f9f deadbeefdeadbeef x.".split() + [" "]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(20)))
        assert spans.joined(secret_lexer.base_spans(text), secret_lexer.KINDS) == plain_spans(text, SECRETS), text
    long = "a1" * 200_000
    assert pii.base_spans(long) == [] and secret_lexer.find_in(long)[1] == []


def test_secrets_follow_names(odd, empty):
    text = 'seed = "Zx81-qq7LmN0"\nother = "plain words"\nclient_secret = seed\n{"db_pwd": "h7Kd93jsQ1"}\nkey = note\n'
    base, added = secret_lexer.find_in(text)
    assert [text[a:b] for a, b, _ in added] == ["Zx81-qq7LmN0", "h7Kd93jsQ1"] and base == []
    assert secret_lexer.find_in("password = changeme1 and the token was lost: nothing")[1] == []
    assert secret_lexer.find_in("a = b\nb = a\nsecret = a")[1] == []
    out = secret_lexer.find(odd).collect()
    assert len(out) == odd.count() and all(r["spans"] == "" for r in out)
    assert secret_lexer.find(empty).count() == 0


@pytest.mark.parametrize(
    ("text", "literals"),
    [
        ("token = 'AKx9' + 'Zq8w' + '7tLm'", ["AKx9", "Zq8w", "7tLm"]),
        ("part = 'AKx9'\nmore = part + 'Zq8w'\nmy_pwd = more + '7tLm'", ["AKx9", "Zq8w", "7tLm"]),
        ("part = 'AKx9Zq8w7tLm'\nmy_pwd = part + part\npart = 'no'", ["AKx9Zq8w7tLm"]),
        ("config['password'] = 'h7Kd93jsQ1'", ["h7Kd93jsQ1"]),
        ("os.environ['DB_PWD'] = 'h7Kd93jsQ1'", ["h7Kd93jsQ1"]),
        ('db_pwd = """h7Kd93\njsQ1"""', ["h7Kd93\njsQ1"]),
        ('db_pwd = f("h7Kd93jsQ1")', ["h7Kd93jsQ1"]),
        ("db_pwd = outer(inner('x', 'h7Kd93jsQ1'), name)", ["h7Kd93jsQ1"]),
        ("db_pwd,x = 'h7Kd93jsQ1','Tz81qq7LmN0'", ["h7Kd93jsQ1"]),
        ("x, db_pwd = 'Tz81qq7LmN0', 'h7Kd93jsQ1'", ["h7Kd93jsQ1"]),
        ("db_pwd, other = load('h7Kd93jsQ1')", ["h7Kd93jsQ1"]),
        ("<password>h7Kd93jsQ1</password>", ["h7Kd93jsQ1"]),
        ("<a><db_pwd kind='x'> h7Kd93jsQ1 </db_pwd></a>", ["h7Kd93jsQ1"]),
        ("db_pwd: str = 'h7Kd93jsQ1'", ["h7Kd93jsQ1"]),
        ("user = 'bob'\ndb_pwd = getpass('Enter: ')", []),
        ("a = b\nb = a\nsecret = a + b", []),
        ("secret = secret + secret", []),
        ("<b>token</b> of 3 <i>secret</i>", []),
    ],
)
def test_secret_forms(text, literals):
    base, added = secret_lexer.find_in(text)
    assert [text[a:b] for a, b, _ in added] == literals and not [s for s in base if s[2] != "assign"]


def test_secret_lexer_takes_linear_time_and_big_folds():
    doubled = "".join(f"p{i} = p{i + 1} + p{i + 1}\n" for i in range(3000)) + "p3000 = 'Zx81qq7L'\npwd = p0 + 'a'"
    found = [doubled[a:b] for a, b, _ in secret_lexer.find_in(doubled)[1]]
    assert found == ["Zx81qq7L", "a"]
    for part in ("pwd=", 'pwd = """\n', "pwd,", "pwd=f(", "pwd=f(a,", "<pwd>", "'pwd'] ", "pwd: x ", "pwd = a + b\n"):
        secret_lexer.find_in(part * 20_000)


def test_revealing_terms_are_generalised(spark, empty):
    filler = [prose(100 + i, 30) for i in range(40)]
    rows = [f"{prose(i, 12)} Zorvath ann@example.org quux {prose(50 + i, 12)}" for i in range(4)]
    texts = [*rows, "only Zorvath here", *filler, None, ""]
    docs = frame(spark, [*texts, rows[0]])
    terms = {r["term"] for r in pii.revealing_terms(docs).collect()}
    assert "zorvath" in terms or "quux" in terms
    assert "quux" in terms and "alpha" not in terms
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert found[0]["n_email"] == 1 and "term:" in found[0]["spans"] and found[0]["base_spans"] in found[0]["spans"]
    clean = {r["doc_id"]: r for r in pii.sanitise(docs).collect()}
    assert "[EMAIL]" in clean[0]["text"] and "@" not in clean[0]["text"] and "quux" not in clean[0]["text"]
    assert clean[5]["text"] == filler[0] and clean[45]["text"] is None and clean[46]["text"] == ""
    assert pii.find(empty).count() == 0 and pii.sanitise(empty).columns == empty.columns


def test_quality_model_learns(spark, empty):
    texts = [prose(i, 40) if i % 3 else " ".join(w.upper() + "!!" for w in prose(i, 40).split()) for i in range(300)]
    docs = frame(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(None, 1, 0), (4, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality_gam.train(docs, labels)
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    scores = {r["doc_id"]: r["score"] for r in quality_gam.score(docs, model).collect()}
    assert np.mean([(scores[i] >= 0.3) == (i % 3 > 0) for i in held]) > 0.95
    assert all(0 <= s <= 1 for s in scores.values()) and len(scores) == 302
    kept = quality_gam.keep(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.3}
    none = quality_gam.train(docs, labels.limit(0))
    assert {round(r["score"], 6) for r in quality_gam.score(docs, none).collect()} == {0.5}
    assert quality_gam.score(empty, model).count() == 0


def test_pair_tables_help_where_single_ones_cannot():
    rnd = np.random.default_rng(0)
    x = rnd.random((4000, len(quality_gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.9


def test_scores_are_sums_of_looked_up_values():
    rnd = np.random.default_rng(1)
    x = np.round(rnd.random((600, len(quality_gam.FEATURES))), 2)  # many values on bin edges
    model = quality_gam.fit(x[:500], (x[:500, 0] + x[:500, 1] * x[:500, 2] > 0.8).astype(float))

    def place(edges, value):
        return sum(e <= value for e in edges)

    for row, got in zip(x, model.score(x), strict=True):
        total = model.base + sum(model.tables[f][place(model.edges[f], v)] for f, v in enumerate(row))
        for (a, b), cells in zip(model.pairs, model.pair_tables, strict=True):
            total += cells[place(model.pair_edges[a], row[a])][place(model.pair_edges[b], row[b])]
        assert got == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)
    assert model.pairs and any(t.any() for t in model.pair_tables)


def plain_mark(text):
    words = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    pieces = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def groups_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints(odd, empty):
    got = Counter((r["doc_id"], r["fp"] % (1 << 64)) for r in simhash.fingerprints(odd).collect())
    assert got == Counter((i, plain_mark(t)) for i, t in expected_rows(odd))
    assert simhash.connected(simhash.fingerprints(empty)).count() == 0


@pytest.mark.parametrize("most", [4, 4096])
def test_links_connect_all_within_the_radius(spark, most):
    rnd = random.Random(most)
    marks = [rnd.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        marks.append(rnd.choice(marks) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 5))))
    marks = sorted(set(marks))
    df = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "fp bigint").repartition(4)
    edges = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in simhash.links(df, 3, most).collect()]
    assert all((a ^ b).bit_count() <= 3 * len(marks) for a, b in edges)
    near = [(a, b) for a in marks for b in marks if a < b and (a ^ b).bit_count() <= 3]
    assert groups_of(edges, marks) == groups_of(near, marks)


def test_longer_keys_are_made_in_the_tasks(spark):
    rnd = random.Random(3)
    masks = simhash.key_masks(3)
    for longer in (1, 2, 3):
        masks = simhash.longer_masks(masks, 3)
        rows = [(_signed(rnd.getrandbits(64)), rnd.randrange(len(masks) // 4)) for _ in range(50)]
        df = spark.createDataFrame(rows, "f bigint, j int")
        got = df.mapInArrow(simhash._longer_keys(longer, 3), "j int, f bigint, part bigint").collect()
        want = [(4 * j + k, f, _signed(f % (1 << 64) & masks[4 * j + k])) for f, j in rows for k in range(4)]
        assert sorted(map(tuple, got)) == sorted(want)


def test_components(spark):
    rnd = random.Random(9)
    pairs = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7)]
    df = spark.createDataFrame([*pairs, (None, 3)], "u bigint, v bigint")
    got = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert got == groups_of(pairs, {n for p in pairs for n in p})
    assert graph.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("together", [5, 512])
def test_near_groups_find_all_similar_texts(spark, together, empty):
    rnd = random.Random(4)
    texts = [prose(200 + i, 90) for i in range(12)]
    for i in range(40):
        words = texts[i % 12].split()
        for _ in range(rnd.randrange(3)):
            words[rnd.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", "one two", "One  two", prose(2, 20000), prose(2, 20000) + " end"]

    def shingles(t):
        words = (t or "").encode().lower().split()
        return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(t) for t in texts]
    near = [
        (i, j)
        for i in range(len(texts))
        for j in range(i + 1, len(texts))
        if (texts[i] or "") == (texts[j] or "") or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0
    ]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r["group_id"] for r in simhash.near_groups(docs, together=together).collect()}
    assert got == groups_of(near, range(len(texts)))
    kept = simhash.one_of_each(docs)
    assert {r["doc_id"] for r in kept.collect()} == set(got.values()) and kept.columns == docs.columns
    assert simhash.one_of_each(empty).count() == 0


def test_near_groups_find_texts_changed_in_one_place(spark):
    texts = []
    for i in range(25):
        words, other = prose(1000 + i, 100).split(), prose(2000 + i, 30).split()
        texts += [words, words + other[:22], words[:82], words[:50] + other[:6] + words[56:]]
        short = prose(3000 + i, 9).split()
        texts += [short, short[:8], prose(4000 + i, 4).split()]
        texts += [[*texts[-1]], prose(5000 + i, 12).split(), prose(5000 + i, 12).split() + other[:2]]
    sets = [{tuple(t[k : k + 5]) for k in range(max(1, len(t) - 4))} for t in texts]
    near = [
        (i, j)
        for i in range(len(texts))
        for j in range(i + 1, len(texts))
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    assert len(near) >= 25 * 6
    docs = frame(spark, [" ".join(t) for t in texts])
    got = {r["doc_id"]: r["group_id"] for r in simhash.near_groups(docs).collect()}
    assert got == groups_of(near, range(len(texts)))


def test_samples_agree_as_often_as_the_similarity_says():
    rnd = np.random.default_rng(1)
    agree = []
    for _ in range(400):
        marks = rnd.integers(0, 1 << 64, 118, np.uint64)
        pair = (np.array(simhash.sampled(m)) for m in (marks[:106], marks[12:]))  # 94 of 118 shared
        agree.append(np.mean(np.equal(*pair)))
    assert abs(np.mean(agree) - (94 / 118) ** 4) < 0.02


def test_decontaminate_against_all_windows(spark, empty):
    items = [prose(300, 30), prose(301, 20), "short item here", None, " ", "again " * 12 + prose(302, 8)]
    words = items[0].split()
    texts = [
        f"{prose(1, 40)} {items[0]} {prose(2, 40)}",
        f"{prose(3, 9)} {' '.join(words[:12] + ['other'] + words[12:])} {prose(4, 9)}",
        f"{prose(5, 9)} {' '.join(words[:14])} {prose(6, 30)}",
        items[1].upper(),
        f"x Short  ITEM here {prose(7, 20)}",
        f"{items[5]} {items[5]}",
        prose(8, 200),
        None,
        "",
    ]
    docs = frame(spark, [*texts, texts[0]])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")

    def counted(words, k):
        return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))

    want = {}
    for d, text in enumerate([*texts, texts[0]]):
        own = (text or "").lower().split()
        for i, item in enumerate(items):
            one = (item or "").lower().split()
            k = min(5, len(one))
            for s in range(max(1, len(own) - len(one) + 1)) if one else ():
                a, b = counted(own[s : s + len(one)], k), counted(one, k)
                share = sum((a & b).values()) / max(1, sum((a | b).values()))
                if share >= 0.8 and share > want.get((d, i), (0,))[0]:
                    want[d, i] = (share, s)
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got.keys() == want.keys()
    for key, (share, start) in want.items():
        assert got[key][0] == pytest.approx(share) and got[key][1] == start
    kept = decontaminate.clean(docs, bench)
    assert {r["doc_id"] for r in kept.collect()} == set(range(10)) - {d for d, _ in want}
    assert kept.columns == docs.columns
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()


def test_decontaminate_loses_no_window_at_the_threshold(spark):
    items = [prose(6000 + i, 49).split() for i in range(300)]
    # One word in the middle: 40 of 50 different shingles are shared.
    texts = [" ".join([*w[:24], f"changed{i}", *w[25:], *prose(7000 + i, 9).split()]) for i, w in enumerate(items)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(frame(spark, texts), bench).collect()}
    assert got == {(i, i): 0.8 for i in range(300)}


def test_decontaminate_finds_reordered_parts(spark):
    items = [prose(9000 + i, 40).split() for i in range(4)] + [prose(9004, 50).split()]
    k = [20, 8, 30, 21, 25]
    texts = [" ".join([*prose(9100 + i, 30).split(), *w[c:], *w[:c], *prose(9200 + i, 30).split()]) for i, (w, c) in enumerate(zip(items, k, strict=True))]
    texts.append(" ".join(items[0][19:] + items[0][:19]))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["start"], r["similarity"]) for r in decontaminate.contaminated(frame(spark, texts), bench).collect()}
    assert got == {(i, i): (30, pytest.approx(42 / 50 if i == 4 else 0.8)) for i in range(5)} | {(5, 0): (0, 0.8)}


def test_terms_of_lines_short_names_and_numbers():
    text = "filler\n" * 40 + "badge K7741\nBo\nLi\nann@example.org\nnext\tline\n" + "more\n" * 60 + "far\u2028away é x"
    base = pii.base_spans(text)
    assert pii.entities(text, base) == {"email:ann@example.org"}
    words = {"filler", "badge", "k7741", "bo", "li", "next", "line", "more", "far", "away"}
    assert pii.terms(text, base) == words


def plain_statistics(texts):
    """Counts of all pairs of the corpus, text by text."""
    texts = [t or "" for t in texts]
    rows = []
    for t in texts:
        base = pii.base_spans(t)
        gone = "".join("\0" if any(a <= i < b for a, b, _ in base) else c for i, c in enumerate(t))
        rows.append((t, {f"{k}:{t[a:b].lower()}" for a, b, k in base}, {w.lower() for w in re.findall(r"[^\W_]{2,}", gone)}))
    out = {}
    for e in {e for _, es, _ in rows for e in es}:
        of_entity = sum(e in es for _, es, _ in rows)
        for w in {w for _, es, ws in rows if e in es for w in ws}:
            both = [t for t, es, ws in rows if e in es and w in ws]
            documents = sum(w in ws for _, _, ws in rows)
            out[e, w] = (len(both), len(set(both)), of_entity, documents)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_term_statistics_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    values = ["ann@example.org", "Bo.Li@example.com", "10.2.3.4", "+44 20 7946 0958"]
    names = ["Zorvath", "K7741", "li", "ÉMILE", "a", "__x__"]
    texts = [None, ""]
    for _ in range(90):
        i = rnd.randrange(4)
        parts = [rnd.choice(WORDS) + str(rnd.randrange(9)) for _ in range(rnd.randrange(12))]
        named = rnd.random() < 0.5
        parts += [names[i]] * named + [values[i]] * (named or rnd.random() < 0.2)
        parts += rnd.sample(values + names, rnd.random() < 0.1)
        rnd.shuffle(parts)
        texts.append(rnd.choice([" ", "\n", "\t", "\u2028"]).join(parts))
    texts += texts[:9] * 2
    docs = frame(spark, texts, [None, *range(len(texts) - 1)])
    want = plain_statistics(texts)
    got = {(r["entity"], r["term"]): (r["both"], r["texts"], r["of_entity"], r["documents"]) for r in pii.statistics(docs).collect()}
    assert got == {k: v for k, v in want.items() if v[1] >= pii.SUPPORT and v[3] * pii.GIVEN <= v[2] + 0.5}
    revealing = {
        w
        for (_, w), (both, n, of_entity, documents) in want.items()
        if n >= pii.SUPPORT and both / documents >= pii.GIVEN
        and 1 + np.log2(both / documents) / -np.log2(of_entity / len(texts)) >= pii.DISCLOSED
    }
    assert revealing and {r["term"] for r in pii.revealing_terms(docs).collect()} == revealing
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    for i, text in enumerate(texts[1:]):
        base = pii.base_spans(text or "")
        assert found[i] == spans.joined(base + pii.term_spans(text or "", base, revealing), pii.KINDS)


def test_far_terms_are_marked_and_names_may_clash(spark):
    """A name far from the address counts; columns named like the operator's own are kept."""
    rows = [f"Zorvath {prose(300 + i, 60)}\nann@example.org" for i in range(4)] + ["Zorvath alone"]
    texts = [*rows, *[prose(400 + i, 30) for i in range(40)]]
    docs = frame(spark, texts).selectExpr("*", "1 AS row", "2 AS known", "3 AS __slot", "4 AS n", "5 AS term", "7L AS n_chars")
    out = pii.sanitise(docs)
    assert out.schema == docs.schema
    got = {r["doc_id"]: r for r in out.collect()}
    assert all(got[i]["text"].startswith("[TERM] ") for i in range(5)) and got[5]["text"] == texts[5]
    assert got[4]["text"] == "[TERM] alone" and got[4]["n_chars"] == 12
    assert {(r["row"], r["known"], r["__slot"], r["n"], r["term"]) for r in got.values()} == {(1, 2, 3, 4, 5)}


def test_window_fingerprints_are_majorities(spark):
    rnd = random.Random(12)
    sets = [[rnd.getrandbits(64) - (1 << 63) for _ in range(k)] for k in (1, 2, 3, 17, 200)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "id int, hashes array<bigint>")
    got = {r["id"]: r["fp"] for r in df.select("id", decontaminate.fingerprint(df["hashes"]).alias("fp")).collect()}
    for i, s in enumerate(sets):
        bits = [2 * sum(h >> b & 1 for h in s) > len(s) for b in range(64)]
        assert got[i] & ((1 << 64) - 1) == sum(1 << b for b in range(64) if bits[b])


def test_hamming_index_finds_every_pair_within_the_radius(spark):
    rnd = random.Random(13)
    items = [rnd.getrandbits(64) for _ in range(60)]
    windows = [x ^ sum(1 << b for b in rnd.sample(range(64), k)) for x in items for k in (0, 12, 20, 21, 22, 23, 24)]
    signed = [[x - (1 << 64) if x >> 63 else x for x in xs] for xs in (windows, items)]
    left = spark.createDataFrame([(i, 20 + i % 2, x) for i, x in enumerate(signed[0])], "w int, n int, fp bigint")
    right = spark.createDataFrame([(i, 20 + i % 2, x) for i, x in enumerate(signed[1])], "item int, n int, fp bigint")
    got = Counter((r["w"], r["item"]) for r in decontaminate.within_radius(left, right).collect())
    want = {
        (i, j)
        for i, x in enumerate(windows)
        for j, y in enumerate(items)
        if i % 2 == j % 2 and (x ^ y).bit_count() <= decontaminate.RADIUS
    }
    assert got == Counter(want) and len(want) > 250


def test_index_alone_finds_windows_at_the_threshold(spark):
    """Not one of 200 windows at a similarity of exactly 0.8 is beyond the radius."""
    items = [prose(6500 + i, 49).split() for i in range(200)]
    texts = [" ".join([*w[:24], f"changed{i}", *w[25:]]) for i, w in enumerate(items)]
    rows = [(i, " ".join(w)) for i, w in enumerate(items)] + [(1000 + i, t) for i, t in enumerate(texts)]
    both = decontaminate._items(spark.createDataFrame(rows, "item_id bigint, text string"))
    windows = both.filter("item_id >= 1000").selectExpr("item_id - 1000 AS w", "n", "fp")
    bench = both.filter("item_id < 1000").selectExpr("item_id AS item", "n", "fp")
    got = {(r["w"], r["item"]) for r in decontaminate.within_radius(windows, bench).collect()}
    assert {(i, i) for i in range(200)} <= got


def test_a_phrase_of_many_items_pairs_nothing(spark):
    opening = prose(8000, 15)
    items = [f"{opening} {prose(8100 + i, 30)}" for i in range(120)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = frame(spark, [f"{opening} {prose(8500 + i, 30)}" for i in range(200)] + [items[7]])
    rare = decontaminate._rarest(decontaminate._items(bench))
    assert rare.groupBy("feature").count().filter("count > 1").count() == 0
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()] == [(200, 7)]


def plain_repeats(texts, n=200):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if count[d[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), len(d) - len(kept), runs, kept))
    return out


@pytest.mark.parametrize("most", [2, 2048])
def test_repeats_are_removed(spark, most, empty):
    shared = prose(400, 45)
    texts = [f"{prose(500 + i, 30)} {shared} {prose(600 + i, 25)}" for i in range(12)]
    texts += [prose(700, 80), prose(700, 80), "é" * 400, "ab" * 500, "x" + "ab" * 120, None, "", "tiny", shared[:199], shared[:200]]
    texts += [texts[0][:150] + texts[1][40:400] + texts[0][100:420], prose(2, 3000), prose(2, 2000)]
    docs = frame(spark, [*texts, texts[3]], [*range(len(texts)), 3])
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(docs, most).collect())
    want = Counter((i, *r) for i, r in zip([*range(len(texts)), 3], plain_repeats([*texts, texts[3]]), strict=True))
    assert got == want
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_array_is_sorted():
    rnd = random.Random(1)
    for _ in range(50):
        text = bytes(rnd.choice(b"ab\0") for _ in range(rnd.randrange(1, 80))) + b"\0"
        codes = np.array([0 if c == 0 else c + 1 for c in text], dtype=np.int16)
        ends = [i for i, c in enumerate(text) if c == 0]

        def key(i, text=text, ends=ends):
            e = next(x for x in ends if x >= i)
            return (text[i:e], b""), e

        # An end sorts before every byte, an earlier end before a later one.
        order = sorted(range(len(text)), key=lambda i: ([c + 1 for c in text[i : key(i)[1]]] + [0], key(i)[1]))
        assert suffix_dedup.suffix_array(codes).tolist() == order


def test_url_rules_and_classes(spark):
    link = '<link rel="canonical" href="{}">'
    pages = [
        (0, "http://A.example.net/en/x?q#f", ""),
        (1, "https://sub.bad.com/de/", ""),
        (2, "http://mirror.example.org/a", link.format("http://sub.bad.com/de/")),
        (3, "http://copy.example.org/b", link.format("http://mirror.example.org/a")),
        (4, "http://fine.org/fr/q", link.format("http://sub.bad.com/de/")),
        (5, "http://other.example.org/b", None),
        (6, None, "x"),
        (7, "no scheme", ""),
        (8, "http://notexample.net", ""),
        (9, "http://p.io/?url=http://blocked.net/x", ""),
        (10, "http://blocked.net/x", ""),
        (10, "http://blocked.net/x", ""),
        (11, "http://rel.io/a/b", '<meta http-equiv="refresh" content="0; url=/c">'),
    ]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("bad.com", "/de/", "block"), ("org", "/fr/", "allow")]
    pages = spark.createDataFrame([(*p, "h") for p in pages], "page_id bigint, url string, html string, host string")
    rules = spark.createDataFrame(rules, "rule_host string, rule_path string, verdict string")
    got = {r["page_id"]: r for r in url_rules.judge(pages, rules).collect()}
    assert url_rules.judge(pages, rules).count() == 13
    assert (got[0]["host"], got[0]["path"], got[0]["rule"], got[0]["verdict"]) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[1]["rule"], got[1]["verdict"]) == ("bad.com/de/", "block")
    assert got[4]["verdict"] == "allow" and got[4]["rule"] == "org/fr/"
    # The class of 1, 2, 3 and 4 has an explicit allow, which goes before its block.
    assert got[2]["verdict"] == got[3]["verdict"] == "allow" and got[2]["component"] == got[4]["component"]
    assert got[9]["verdict"] == "block" and got[9]["rule"] is None and got[10]["verdict"] == "block"
    assert got[5]["verdict"] == "allow" and got[5]["component"] is None
    assert (got[6]["host"], got[6]["path"], got[6]["verdict"]) == ("", "", "allow") and got[7]["host"] == ""
    assert got[8]["rule"] is None and got[8]["path"] == ""
    assert url_rules.judge(pages.limit(0), rules).count() == 0


# Pages of one site, each with a link form and the page that it names.
LINK_FORMS = [
    ("http://a.io/?next=1&url=https%3A%2F%2Fb.io%2Fx%3Fq%3D1%2B2", "", "b.io/x?q=1+2"),
    ("http://a.io/?dest=http://b.io/1&target=http%3a%2f%2fb.io%2f2", "", "b.io/1 b.io/2"),
    ("http://a.io/?url=http://b.io/%zz", "", "b.io/%zz"),
    ("http://a.io/?url=/own/path", "", ""),
    ("http://a.io/p", "<LINK href=http://b.io/y rel=canonical>", "b.io/y"),
    ("http://a.io/p", "<link rel='x canonical' href='//B.io/y?a=1&amp;b=2'/>", "b.io/y?a=1&b=2"),
    ("http://a.io/p", '<meta content="3; URL=\'http://b.io/z\'" http-equiv="Refresh">', "b.io/z"),
    ("http://a.io/p", '<meta content="http://b.io/o" property="og:url">', "b.io/o"),
    ("http://a.io/p", "<link rel=canonical href=http://b.io/1><link href=http://b.io/2 rel=canonical>", "b.io/1 b.io/2"),
    ("http://a.io/d/e/f.html", '<link rel="canonical" href="g.html">', "a.io/d/e/g.html"),
    ("http://a.io/d/e/f.html", '<link rel="canonical" href="../g?x#y">', "a.io/d/g?x"),
    ("http://a.io/d/e/f.html", '<link rel="canonical" href="./../../../h/..">', "a.io/"),
    ("http://a.io/d/e/f.html?k", '<link rel="canonical" href="?j=2">', "a.io/d/e/f.html?j=2"),
    ("http://a.io", '<link rel="canonical" href="g">', "a.io/g"),
    ("http://a.io/d/e", '<link rel="canonical" href="/x/./y/../z">', "a.io/x/z"),
    ("http://a.io/d/e", '<link rel="canonical" href="#top"><link rel="canonical" href="mailto:a@b.io">', ""),
    ("http://a.io/d/e", '<link rel="stylesheet" href="/s.css"><meta name="x" content="http://b.io/">', ""),
    ("http://a.io/d/e", "<link rel=canonical " * 20000, ""),
    ("http://a.io/d/e", None, ""),
    (None, "<link rel=canonical href=http://b.io/y>", ""),
]


def test_forms_of_links(spark):
    pages = spark.createDataFrame([p[:2] for p in LINK_FORMS], "url string, html string")
    for (url, html, expected), row in zip(LINK_FORMS, pages.collect(), strict=True):
        assert (row["url"], row["html"]) == (url, html)
        got = url_rules.links(spark.createDataFrame([row], pages.schema)).collect()
        assert sorted(r["v"] for r in got) == expected.split(), (url, html and html[:90])


def test_classes_of_link_forms_equal_the_sql(spark):
    pages = [(i, url, html) for i, (url, html, _) in enumerate(LINK_FORMS)]
    pages += [(100, "http://b.io/x?q=1+2", ""), (101, "http://x.net/d/", ""), (102, "http://c.io/", "<link href=//x.net/d/ rel=canonical>")]
    pages += [(103, "http://x.net/e/f", '<link rel="canonical" href="../d/">'), (104, "http://d.io/?url=http%3A%2F%2Fc.io%2F", None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    rules = spark.createDataFrame(queries.URL_RULES, "rule_host string, rule_path string, verdict string")
    got = sorted(map(tuple, url_rules.judge(df, rules).collect()), key=repr)
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    expected = con.execute(f"SELECT page_id, host, path, rule, verdict, component FROM ({queries._url_sql()})").fetchall()
    assert got == sorted(expected, key=repr)
    assert {r[0]: r[4] for r in got}[104] == "block"


def test_masking_keeps_what_is_between():
    assert pii.masked("a 1.2.3.4 b", [(2, 9, "ip")]) == "a [IP] b"
    assert hashlib.sha256(pii.masked("abc", []).encode()).hexdigest() == hashlib.sha256(b"abc").hexdigest()
