"""Merkle manifest, fill-in-middle and token counts against plain versions, with odd rows and other shapes of trees."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest

from tests.conftest import SF
from tidepool.llm import fim, merkle, token_counts
from tidepool.llm.queries import ORACLE_SQL, QUERIES, vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string, node int, digest string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def up(nodes, f):
    return [sha("".join(nodes[i : i + f])) for i in range(0, len(nodes), f)]


def steps(nodes, at, f):
    """(left, right) siblings of node ``at`` on every level, and the root."""
    out = []
    while len(nodes) > 1:
        run = at // f * f
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + f])))
        nodes, at = up(nodes, f), at // f
    return out, nodes[0]


def manifest(rows, f):
    def leaf(r, more=0):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1])))

    groups, out = {}, []
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
    roots = []
    for g in names:
        nodes = [x[2] for x in groups[g]]
        roots.append(steps(nodes, 0, f)[1])
    for k, g in enumerate(names):
        nodes = [x[2] for x in groups[g]]
        for i, (_, _, own, r) in enumerate(groups[g]):
            a, sub = steps(nodes, i, f)
            b, root = steps(roots, k, f)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            v = leaf(r, 1) if bad else own
            for left, right in a + b:
                v = sha(left + v + right)
            out.append((r[0], own, sub, root, sha("".join(x + y for x, y in a + b)), v, v == root))
    return sorted(out, key=str)


def odd_documents(n=70, langs=9, seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(["big", "big", None, *[f"l{k}é" for k in range(langs)]])
        rows.append((r.choice([i, i, None]), r.choice(["", None, "some tëxt", "word " * 500]), lang, r.choice(["s", None]), r.choice([None, 3, 9, 99]), "x", 1, "y"))
    return rows + rows[:6]


@pytest.mark.parametrize(("fanout", "depth", "langs"), [(2, 12, 9), (2, 2, 30), (3, 1, 9), (4, 2, 0)])
def test_manifest(spark, fanout, depth, langs):
    rows = odd_documents(langs=langs)
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), fanout, depth=depth).collect()
    want = manifest(rows, fanout)
    assert sorted(map(tuple, got), key=str) == want
    bad = [w for w in want if not w[-1]]
    assert bad and all(w[0] is not None and zlib.crc32(str(w[0]).encode()) % 7 == 0 for w in bad)


def test_manifest_of_one_row_and_none(spark):
    rows = [(3, "a", "en", None, None, "", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    (r,) = merkle.manifest(df).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == sha("") and r.verified
    assert merkle.manifest(df.limit(0)).count() == 0


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def cut_in_three(doc_id, text):
    text = text or ""
    u, d = UNIT.findall(text), sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    i, j = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:i]), "".join(u[i:j]), "".join(u[j:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(u), "plain", None, None, sha(text), sha(text)
    psm = h[3] % 100 >= 80
    return doc_id, len(u), "psm" if psm else "spm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}" if psm else f"<S>{s}<P>{p}<M>{m}"), sha(text)


def test_fim(spark, monkeypatch):
    r = random.Random(1)
    texts = ["", None, " ", "\n\n a", "a \t", "é😀 x y 日本", "has <P> in it", "ends with <", "<S", "> P>", "a" * 3000, "w " * 20_000, *("".join(r.choice("ab é\n\x0b<>PS") for _ in range(r.randint(0, 60))) for _ in range(60))]
    rows = [(r.choice([i, i + 1000, None]), t, "n", 5) for i, t in enumerate(texts * 3)] + [(10_000 + i, "one text of a third of all rows\n", "n", 5) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string, list int").repartition(7)
    want = sorted((cut_in_three(*x[:2]) for x in rows), key=str)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    for part in (512, 16):  # salted in one part and in several
        monkeypatch.setattr(fim, "PART_ROWS", part)
        assert sorted(map(tuple, fim.digests(df).collect()), key=str) == want
    out = fim.transform(df, rate=100, spm=0).where("form = 'psm'")
    assert out.select(fim.restored(out.output, out.form).alias("back"), "text").where("back <> text or back is null").count() == 0 < out.count()
    assert fim.digests(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 511, 512, 513, 3000])
def test_boundary_lists(n):
    r = random.Random(n)
    for widest in (1, 2, 9, 5000):
        ends = []
        for _ in range(n):
            ends.append((ends[-1] if ends else 0) + r.randint(1, widest))
        import numpy as np

        raw = fim.packed(np.array(ends))
        assert [fim.selected(raw, n, i) for i in range(n)] == ends
        if n > 500 and widest == 9:
            assert len(raw) < n
    assert fim.packed(pa.array([], pa.int64()).to_numpy()) == b""


def test_unit_ends_of_slices():
    col = pa.array(["skipped", " a b ", None, "", "\té\n\n", "日 本"]).slice(1)
    ends, n = fim.unit_ends(col)
    assert ends.tolist() == [2, 4, 5, 2, 4, 1, 3] and n.tolist() == [3, 0, 0, 2, 2]


def test_token_counts(spark):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    lib, r = Tokenizer.from_file(path), random.Random(2)
    letters = "ab'sS tT́éÉΣς ΑΣ İ\x1c\x85​日本😀12３\x00"
    texts = [None, "", " \n", "don't STOP", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "ꟋꟜ", "y" * 50_000, "ab" * 9_000, "word " * 3000]
    texts += ["".join(r.choice([r.choice(letters), r.choice(["<|endoftext|>", "'ll", "'re", "ing "])]) for _ in range(r.randint(0, 50))) for _ in range(500)]
    rows = [(i if i % 9 else None, t, -1) for i, t in enumerate(texts)] + [(1, "", -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    want = [(i, len((t or "").encode()), k := len(lib.encode(t or "", add_special_tokens=False).ids), k > 2048) for i, t, _ in rows]
    assert sorted(map(tuple, token_counts.token_counts(df, path).collect()), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(df.limit(0), path).count() == 0


def test_token_counts_on_documents(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in QUERIES["op12_token_counts"](spark, SF).collect()}
    assert got == {i: len(e.ids) for i, e in zip(docs, lib.encode_batch(list(docs.values()), add_special_tokens=False), strict=True)}


def test_merges_are_the_lowest_rank_first():
    rule = token_counts.PLACE
    pair = {1 << token_counts.SYMBOL | 1: (1 << rule, 2), 2 << token_counts.SYMBOL | 1: (0, 3), 2 << token_counts.SYMBOL | 2: (2 << rule, 4)}
    # 1 1 1 1: the leftmost pair merges, then (2, 1) before the other (1, 1); what is left doesn't merge
    assert token_counts.merged([1, 1, 1, 1], pair) == 2 and token_counts.merged([1], pair) == 0


def test_words_beyond_the_store(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 3)
    c = token_counts.Counter(vocabulary("word_bpe_49k.json"))
    words = [f"w{chr(97 + i)}" for i in range(12)] * 2
    assert [c.count(w) for w in words[:12]] == [c.count(w) for w in words[12:]] and len(c) <= 3


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_fill_in_middle"])
def test_twins(spark, duck, name):
    from tests.test_oracle import rows

    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(ORACLE_SQL[name]).df())
