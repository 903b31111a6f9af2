"""Each operator against a brute-force version, an exact round trip or held-out accuracy, on the smallest tables."""

import functools
import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF
from tidepool.llm import embedding, fingerprint, flat, html, labelled, ngram_join, packing, pieces, quality, spans, suffix_lm, toxicity
from tidepool.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def variants(seed=3, n=60):
    """Texts with copies of many degrees and a shared passage."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdef") for _ in range(4))
    base, passage, out = [[word() for _ in range(r.randint(3, 60))] for _ in range(8)], [word() for _ in range(30)], []
    for i in range(n):
        w = list(base[i % 8])
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = word()
        out.append((i, " ".join(w + passage * (i % 3 == 0))))
    return out


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_ngram_join(spark, docs, k, percent):
    rows = variants() + [(r.doc_id + 1000, r.text) for r in docs.select("doc_id", "text").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def shingles(t):
        w = WORD.findall((t or "").translate(LOWER))
        return {tuple(w)} - {()} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = components(sets, links)
    got = ngram_join.ngram_join(df, k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_embedding(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base, base[:20] + rng.normal(size=(20, 16)) * 0.1, base[:6], base[:20] + rng.normal(size=(20, 16)) * 0.02])
    label = np.arange(len(x)) % 2
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = components(range(len(x)), zip(*np.nonzero(near), strict=True))
    df = spark.createDataFrame([(i, v.tolist(), int(label[i])) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding.near_dedup(df, block=8).collect()}
    found = sum(r.n_links for r in got.values())
    assert found <= near.sum() and found >= 0.99 * near.sum()
    assert [got[i].component_id for i in range(len(x))] == [want[i] for i in range(len(x))]


def test_window_keeps_recall():
    half, least = embedding.calibrate(0.98, 24, 0.999)
    p = math.erf(half / math.sqrt(0.04) / math.sqrt(2))
    assert sum(math.comb(24, k) * p**k * (1 - p) ** (24 - k) for k in range(least, 25)) >= 0.999


@pytest.mark.parametrize(("f", "column"), [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_classifiers_held_out(spark, f, column):
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = f(spark.read.parquet(f"{sf}/documents.parquet"), labels).toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out, strict=True))
    assert out.score.between(0, 1).all()
    m = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    pos, neg = m.score[m[column] == 1], m.score[m[column] == 0]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.85


def test_factorisation_machine_identity():
    rng = np.random.default_rng(0)
    m = quality.Machine()
    m.w = rng.normal(size=len(m.w))
    i, x = np.array([1, 5, 9, 30]), np.array([0.5, 1.0, -2.0, 0.3])
    pairs = sum(m.v[i[a]] @ m.v[i[b]] * x[a] * x[b] for a in range(4) for b in range(a + 1, 4))
    assert np.isclose(m.margin(np.zeros(4, int), i, x, 1)[0], m.w[i] @ x + pairs)


def test_factorisation_machine_rows():
    rng = np.random.default_rng(0)
    count = np.array([3, 0, 5, 1])
    bucket, code = rng.integers(0, quality.WORDS, 9).astype(np.int16), rng.integers(0, quality.BINS, (4, quality.STATS)).astype(np.int16)
    want, at = [], 0
    for d, k in enumerate(count):
        want += [(d, int(b), 1 / np.sqrt(k)) for b in bucket[at : at + k]] + [(d, quality.WORDS + j * quality.BINS + int(c), 0.5) for j, c in enumerate(code[d])]
        at += k
    assert list(zip(*(x.tolist() for x in quality.rows(count, bucket, code)), strict=True)) == want


def test_quality_fit_holds_two_bytes_a_word(spark):
    texts = [(i, " ".join(f"w{(i * 37 + j) % 50_000}" for j in range(200))) for i in range(2_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    words = 200 * sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(2_000))
    tracemalloc.start()
    try:
        edges, _ = quality.fit(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # 29.6 MB with indices and values of all words at once, 12.8 MB with those of one step
    assert edges is not None and peak < 16e6 + 8 * words


def test_isotonic_is_monotone():
    rng = np.random.default_rng(0)
    at, rate = toxicity.isotonic(rng.normal(size=200), rng.integers(0, 2, 200).astype(float))
    assert (np.diff(rate) >= 0).all() and (np.diff(at) >= 0).all()


def test_html_articles(spark):
    import html as entities

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in html.extract(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", raw[r.page_id], re.S)[1]
        want = " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert r.text == want and r.n_chars == len(want)


def test_html_without_article():
    tree = html.grow(*html.labelled())
    body = "This paragraph has many words and tells a story that goes on for quite a while, as paragraphs do. "
    page = f"<body><ul class='menu'><li><a href=x>Home</a></ul><div><h2>A title</h2><p>{body}<p>{body}</div><div class='cookie-banner'>{body}</div><form>{body}</form><div id='comments'><p>{body}</p></div><footer>{body}</footer>"
    blocks, x = html.blocks(page)
    kept = [t for t, k in zip(blocks, html.classify(tree, x), strict=True) if k]
    assert kept == ["A title", body.strip(), body.strip()]


def test_html_counts_and_densities_decide():
    tree = html.grow(*html.labelled())
    body = "This paragraph has many words and tells a story that goes on for quite a while, as paragraphs do."
    links = "".join(f"<li><a href={i}>Story {i}</a></li>" for i in range(4))
    pages = [f"<body><div>{links}</div><div><p>{body}</p><p>{body}</p></div>", f"<body><article><p>{body}</p><p><a href=x>One link</a></p><p>{body}</p><ul>{links}</ul><p>{body}</p></article>"]
    for page, want in zip(pages, ([body] * 2, [body, "One link", *[body] * 2]), strict=True):
        texts, x = html.blocks(page)
        kept = [t for t, k in zip(texts, html.classify(tree, x), strict=True) if k]
        assert [t for t in kept if not t.startswith("Story")] == want and len([t for t in kept if t.startswith("Story")]) <= 2
        other = x.copy()
        other[:, :6] = np.roll(other[:, :6], 2, axis=0)
        assert (html.classify(tree, other) != html.classify(tree, x)).any()


@pytest.mark.parametrize("piece", ["<a ", '<a href="x ', '<a "> "', "</script", "<section></div>", "<div>", "<!-", "<p '", "<b x=\"'>"])
def test_html_odd_long_pages_take_linear_time(piece):
    import time

    for start, end in (("", ""), ("<p>", ">"), ("<script>", "")):
        began = time.process_time()
        html.blocks(start + piece * (500_000 // len(piece)) + end)
        assert time.process_time() - began < 8


def test_html_wrappers_that_only_sound_hidden():
    tree = html.grow(*html.labelled())
    body = "This paragraph has many words and tells a story that goes on for quite a while, as paragraphs do."

    def kept(attrs):
        blocks, x = html.blocks(f"<body><nav>Home</nav><div {attrs}><article><h1>A title</h1><p>{body}</p></article></div>")
        return [t for t, k in zip(blocks, html.classify(tree, x), strict=True) if k]

    shown = ["style='overflow:hidden'", 'style="overflow: hidden; color: red"', 'aria-hidden="false"', "class='overflow-hidden'", "class='md:hidden'", "data-state=hidden", "title='the hidden one'", "data-class='nav'", "data-note='display: none'"]
    assert [a for a in shown if kept(a) != ["A title", body]] == []
    unseen = ["hidden", "HIDDEN", 'hidden=""', "id=x hidden", "aria-hidden=true", "aria-hidden='true'", "style='display:none'", 'style="color: red; display : none"', "class='a hidden'", "class=visually-hidden", "class='nav'"]
    assert [a for a in unseen if kept(a)] == []


def test_suffix_tree(docs, texts):
    got = suffix_lm.score(docs).toPandas()
    words = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts.items()}
    count = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, kinds = sum(count.values()), len(count)
    for r in got.itertuples():
        ws = words[r.doc_id]
        assert r.n_tokens == len(ws) and r.n_known == sum(count[w] > 0 for w in ws) and r.train_tokens == total
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws))
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


@pytest.mark.parametrize("group", [4_000_000, 500])
def test_suffix_tree_states_and_scores(spark, docs, texts, group):
    """The tree, spelled out: counts of all contexts, gains over the suffix, longest kept state."""
    depth, p_min, gain = 3, 4e-4, 4.0
    seqs = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts.items()}
    seqs[-1] = seqs[-2] = [None]
    contexts = lambda ws, j: [tuple(["^", *ws][j - k : j + 1]) for k in range(min(depth, j + 1))]
    n, total = {(): Counter()}, 0
    for i, ws in seqs.items():
        if zlib.crc32(str(i).encode()) % 10:
            for j, w in enumerate(ws):
                total += 1
                for c in [(), *contexts(ws, j)]:
                    n.setdefault(c, Counter())[w] += 1
    size = {c: sum(v.values()) for c, v in n.items()}
    frequent = {c for c in n if c == () or size[c] >= p_min * total}

    def p(w, c, states):
        if c == ():
            return (n[()][w] + 0.1) / (total + 0.1 * (len(n[()]) + 1))
        up = c[1:]
        while up not in states:
            up = up[1:]
        return (n[c][w] + len(n[c]) * p(w, up, states)) / (size[c] + len(n[c]))

    kept = {()}
    for c in frequent - {()}:
        q = {w: p(w, c[1:], frequent) for w in n[c]}
        if sum(m * math.log((m - 1 + len(n[c]) * q[w]) / (size[c] - 1 + len(n[c])) / q[w]) for w, m in n[c].items()) >= gain:
            kept.add(c)
    assert {len(c) for c in kept} == {0, 1, 2, 3}
    rows = spark.createDataFrame([*((i, t) for i, t in texts.items()), (-1, None), (-2, "")], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in suffix_lm.score(rows, depth, p_min, gain, group).collect()}
    for i, ws in seqs.items():
        want = sum(math.log10(p(w, next(c for c in [*reversed(contexts(ws, j)), ()] if c in kept), kept)) for j, w in enumerate(ws))
        assert got[i] == pytest.approx(want), i


def test_suffix_tree_sums_to_one():
    rng = np.random.default_rng(2)
    x, s, n = suffix_lm._summed(rng.integers(1, 30, 400).astype(np.uint64), rng.integers(0, 4, 400).astype(np.int32), np.ones(400, np.int64))
    root = s == 0
    total = np.array([n[s == i].sum() for i in range(4)], dtype=float)
    kinds = np.array([(s == i).sum() for i in range(4)], dtype=float)
    keep = np.isin(x, x[root])
    x, s, n = x[keep], s[keep], n[keep]
    total = np.array([n[s == i].sum() for i in range(4)], dtype=float)
    kinds = np.array([(s == i).sum() for i in range(4)], dtype=float)
    table = suffix_lm.Table(x, s, n, 4)
    m = (total, kinds, np.array([0, 0, 1, 2], np.int32), total[0], kinds[0], 3)
    for state in range(4):
        known = suffix_lm.chance(table, np.arange(len(table.symbol)), np.full(len(table.symbol), state, np.int32), m).sum()
        unknown = suffix_lm.chance(table, np.array([-1]), np.array([state], np.int32), m).sum()
        assert known + unknown == pytest.approx(1)


def seeded(parts: list[str]) -> int:
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=h)
    return h


def paragraphs(text: str) -> set[str]:
    words, out = re.findall(r"\S+\s*|\s+", text, re.A), [""]
    for w, after in zip(words, [*words[1:], None], strict=True):
        out[-1] += w
        if after is not None and (seeded([w, after]) % 16 == 0 or "\n" in w):
            out.append("")
    return set(out) if text else set()


def digest(parts: set[str]) -> set[int]:
    return {seeded([p]) for p in parts}


def sketch_of(written: str) -> tuple[int, dict]:
    """Level and cells (shard, cell) -> [count, digests, checks] of a returned fingerprint."""
    *_, level, cells = written.split("-")
    rows = [c.split(":") for c in cells.split(",") if c]
    return int(level), {(int(s), int(i)): [int(c), int(k, 16), int(h, 16)] for s, i, c, k, h in rows}


def peeled(cells: dict) -> set | None:
    """The digests of cells, found again from counts and checks alone."""
    word = lambda *xs: functools.reduce(lambda h, x: xxhash.xxh64_intdigest(x, seed=h), xs, 42)
    check = lambda k: word(k.to_bytes(8, "little"), (77).to_bytes(4, "little"))
    out, cells = set(), {x: list(v) for x, v in cells.items()}
    while pure := next(((x, v) for x, v in cells.items() if abs(v[0]) == 1 and v[2] == check(v[1])), None):
        (shard, _), (c, k, h) = pure[0], list(pure[1])
        out.add((c, k))
        turned = word(k.to_bytes(8, "little"), (5).to_bytes(4, "little"))
        for r in range(4):
            v = cells[shard, (turned >> (5 * r)) % 32 + 32 * r]
            v[0], v[1], v[2] = v[0] - c, v[1] ^ k, v[2] ^ h
    return None if any(any(v) for v in cells.values()) else out


def between(x: str, y: str) -> set:
    """The signed digests in which two returned fingerprints differ."""
    (lx, cx), (ly, cy) = sketch_of(x), sketch_of(y)
    left: dict = {}
    for cells, sign in ((cx, 1), (cy, -1)):
        for (shard, i), (c, k, h) in cells.items():
            v = left.setdefault((shard % 4 ** min(lx, ly), i), [0, 0, 0])
            v[0], v[1], v[2] = v[0] + sign * c, v[1] ^ k, v[2] ^ h
    if (found := peeled(left)) is None:
        a, b = ({k for _, k in peeled(c)} for c in (cx, cy))
        found = {(1, k) for k in a - b} | {(-1, k) for k in b - a}
    return found


def test_fingerprints(docs, texts):
    ids = sorted(texts, reverse=True)
    like = lambda a, b: 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))
    got = {r.doc_id: r for r in fingerprint.edits(docs, ranges=3).collect()}
    for i, d in enumerate(ids):
        text, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = (paragraphs(t) for t in (text, edited, after))
        assert got[d].n_chars == len(text) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d].near_edited == pytest.approx(like(a, b)) and got[d].near_next == pytest.approx(like(a, c))
        assert (got[d].fingerprint == got[d].edited_fingerprint) == (text == edited)
        assert between(got[d].fingerprint, got[d].edited_fingerprint) == {(1, k) for k in digest(a - b)} | {(-1, k) for k in digest(b - a)}
        other = got[ids[(i + 1) % len(ids)]].fingerprint
        assert between(got[d].fingerprint, other) == {(1, k) for k in digest(a - c)} | {(-1, k) for k in digest(c - a)}


def test_fingerprint_survives_an_insertion(spark):
    r = random.Random(11)
    words = " ".join(f"w{r.randrange(900)}" for _ in range(4000))
    middle = words.replace(" ", " more ", 1)
    rows = {2: words, 1: "word " + words, 4: middle, 3: words}
    got = {x.doc_id: x for x in fingerprint.edits(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), ranges=2).collect()}
    assert got[2].near_next > 0.98 and got[4].near_next > 0.98 and got[3].near_next == 1.0
    found = between(got[2].fingerprint, got[1].fingerprint)
    assert 0 < len(found) <= 4 and {k for s, k in found if s > 0} == digest(paragraphs(words) - paragraphs("word " + words))


def test_lookup_sketch_recovers_digests(spark):
    r = random.Random(4)
    x = [r.getrandbits(62) for _ in range(300)]
    y = x[40:] + [r.getrandbits(62) for _ in range(50)]
    pairs = spark.createDataFrame([(1, x, y), (2, x, x), (3, [], y[:3])], "id long, x array<long>, y array<long>")
    got = {r.id: {(d.c, d.k) for d in r.diff} for r in fingerprint.differences(pairs, ["id"]).collect()}
    assert got == {1: {(1, k) for k in x[:40]} | {(-1, k) for k in y[260:]}, 2: set(), 3: {(-1, k) for k in y[:3]}}


def test_sentencepiece(texts):
    from sentencepiece import SentencePieceProcessor

    sp, r = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model")), random.Random(5)
    sample = [*texts.values(), "", " ", "a  b", "\n\n x", "▁x", "x\u0000y", "é́ ﬁ日本😀", "<s> </s> <0x0A>", "a" * 300, "    " * 40]
    sample += ["".join(r.choice("abc ▁\n\téaatheingion129.,日 ") for _ in range(r.randint(0, 80))) for _ in range(500)]
    enc = pieces.Encoder(vocabulary("piece_bpe_32k.model"), cache_words=2000)
    for at in range(0, len(sample), 50):
        part = sample[at : at + 50]
        ids, bounds = enc.ids(part)
        back = pieces.decode(enc.m, ids, bounds)
        for k, t in enumerate(part):
            want = sp.encode(t)
            assert ids[bounds[k] : bounds[k + 1]].tolist() == want and back[k] == sp.decode(want)


def test_sentencepiece_long_runs():
    from sentencepiece import SentencePieceProcessor

    sp, r = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model")), random.Random(6)
    enc = pieces.Encoder(vocabulary("piece_bpe_32k.model"))
    start = time.monotonic()
    marks = [" " * 16_000, "-" * 16_001, "=" * 3000 + "a" * 3000, "\n" * 5000, "ab" * 8000, "x" + " " * 9001 + "y", "*-" * 4000 + "*" * 777]
    mixed = ["".join(r.choice(["  ", "-", "--", "a", "an", "_", "__"]) for _ in range(r.randint(100, 3000))) for _ in range(40)]
    texts = marks + mixed + [" " * n + "=" * (n // 3) for n in range(100, 400, 7)]
    ids, bounds = enc.ids(texts)
    assert time.monotonic() - start < 10
    for k, t in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == sp.encode(t)


def test_spans(spark, docs, texts):
    extra = {10_000: "Alpha beta. " + "gamma delta epsilon. " * 3 + "Zeta eta theta iota kappa lambda mu nu xi omicron pi rho. " * 3, 10_001: "other start here " + "Zeta eta theta iota kappa lambda mu nu xi omicron pi rho. " * 3}
    texts = texts | extra
    df = docs.select("doc_id", "text").union(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))

    def units(t):
        out = []
        for line in t.split("\n"):
            cur = []
            for w in WORD.findall(line):
                cur.append(w.translate(LOWER))
                if w[-1] in ".!?" or int(flat.words(pa.array([w])).hash[0]) % spans.CLAUSE == 0:
                    out.append(cur)
                    cur = []
            if cur:
                out.append(cur)
        return out

    cut, seen = {i: units(t) for i, t in texts.items()}, {}
    for i, u in cut.items():
        for s in range(len(u)):
            for e in range(s + 2, len(u) + 1):
                words = tuple(w for x in u[s:e] for w in x)
                if len(words) >= spans.MIN_WORDS:
                    seen.setdefault(words, []).append((i, s, e))
                    break
    gone = {i: set() for i in cut}
    for places in seen.values():
        for i, s, e in sorted(places)[1:]:
            gone[i] |= set(range(s, e))
    for r in spans.dedup_spans(df).collect():
        u = cut[r.doc_id]
        assert (r.n_sentences, r.n_removed) == (len(u), len(gone[r.doc_id]))
        assert WORD.findall((r.text or "").translate(LOWER)) == [w for k, x in enumerate(u) if k not in gone[r.doc_id] for w in x]


def test_embedding_recall_of_cells_and_count():
    """Joint recall of a pair at the bound, by drawing pairs; the number of cells follows the rows, the work doesn't."""
    half, least = embedding.calibrate(0.98, recall=0.999)
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(2, 20_000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1)[:, None]
    size, groups = embedding.grouping(1 << 20, 0.98, half, 0.999)
    meet = (embedding._keys(a, size, groups, 4 * half) == embedding._keys(b, size, groups, 4 * half)).any(axis=1)
    d = embedding.directions(64, 24)
    assert (meet & ((np.abs(a @ d - b @ d) <= half).sum(axis=1) >= least)).mean() >= 0.998
    far = embedding.shared_cell(4 * half, math.sqrt(2))
    work = [g * far**k * n for n in (1 << 14, 1 << 20, 1 << 26) for k, g in [embedding.grouping(n, 0.98, half, 0.99999)]]
    assert work[1] < 0.1 * (1 << 20) and work[2] / work[0] < (1 << 12) ** 0.3


def test_spans_find_unaligned_passages(spark, monkeypatch):
    import corpus_pipeline
    from tidepool.llm import queries

    r = random.Random(9)
    word = lambda: f"w{r.randrange(10**9)}" + ("." if r.random() < marks else "")
    rows, passages = [], {}
    for i in range(600):
        marks = (0, 0.09)[i % 2]
        passage = [word() for _ in range(51 if i % 3 else spans.MIN_WORDS + 2 * spans.GAP - 1)]
        for d in (2 * i, 2 * i + 1):
            before, after = ([word() for _ in range(r.randrange(40))] for _ in range(2))
            rows.append((d, " ".join([*before, *passage, *after])))
        passages[2 * i + 1] = set(passage), before + after
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: df)
    for out in (queries.op9_substring_dedup(spark, ""), corpus_pipeline.repeated_passages(spark, df, "")):
        text = {x.doc_id: x.text.split() for x in out.collect()}
        assert all(text[d] == t.split() for d, t in rows if d % 2 == 0)
        left = {d: sum(w in p for w in text[d]) for d, (p, _) in passages.items()}
        missed = [d for d, n in left.items() if n == len(passages[d][0])]
        assert len(missed) == 0, f"{len(missed)} of {len(left)} passages missed"
        assert max(left.values()) <= 2 * spans.GAP - 1
        assert all([w for w in text[d] if w not in p] == around for d, (p, around) in passages.items())


def test_packing(spark, docs, texts):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    rows = [r.asDict() for r in packing.pack(docs.repartition(3), path, with_ids=True).collect()]
    want = {i: [*lib.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    got = {i: [] for i in want}
    for r in sorted(rows, key=lambda r: r["start"]):
        assert len(got[r["doc_id"]]) == r["start"] and r["doc_tokens"] == len(want[r["doc_id"]]) and r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        got[r["doc_id"]] += r["ids"]
    assert got == want
    windows = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["offset"] == windows.get(r["sequence_id"], 0)
        windows[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in windows.values())


def test_step_groups_are_equal(docs):
    path = vocabulary("byte_bpe_50k.json")
    # a small pool: several flushes a task
    rows = packing.pack(docs.unionByName(docs).repartition(2), path, pool_tokens=8192, step_tokens=4096).collect()
    tasks: dict[int, dict[int, int]] = {}
    for r in rows:
        groups = tasks.setdefault(r.step_group >> 33, {})
        groups[r.step_group] = groups.get(r.step_group, 0) + r.length
    assert len(tasks) == 2
    for groups in tasks.values():
        assert len(groups) > 4 and all(n == 4096 for g, n in groups.items() if g != max(groups)) and 0 < groups[max(groups)] <= 4096
    with pytest.raises(ValueError):
        packing.pack(docs, path, step_tokens=1000)


def test_sample_is_bounded(spark):
    many = [(7, f"text {i:05d}") for i in range(3000)] + [(i, f"other {i}") for i in range(8, 60)]
    labels = [(7, 1), (7, 0), (7, None), *[(i, i % 2) for i in range(8, 60)]]
    got = labelled.sample(spark.createDataFrame(many, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), "quality", 10).collect()
    assert len(got) == 10 == len({r.doc_id for r in got})
    got = labelled.sample(spark.createDataFrame(many, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), "quality").collect()
    assert {r.doc_id for r in got} == {i for i in range(7, 60) if zlib.crc32(str(i).encode()) % 5}
    assert all((r.text, r.y) == ("text 00000", 1) for r in got if r.doc_id == 7)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, last = docs, len(corpus_pipeline.STAGES) - 1
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, SF)
        if i < last:
            assert out.columns == docs.columns
        if i < 3:
            assert out.exceptAll(rows).isEmpty()
        rows = out
    assert corpus_pipeline.run(spark, SF).select("doc_id", "start", "ids_crc32").exceptAll(rows.select("doc_id", "start", "ids_crc32")).isEmpty()
