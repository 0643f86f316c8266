"""Each operator on a small table with nulls, empty and very long texts, ties, repeated rows and clashing names, and on none."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest


from sparkloom.llm import bpe, components, decontaminate, html_render, jaccard, line_dedup, lm, quality, simhash, token_files, toxicity
from tests.llm import brute

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, score double, ids string, n_hit long, n_lines string, _lines int, bucket string, items int"


def words_of(rng, n):
    return " ".join(rng.choice(["Alpha", "beta", "gamma", "delta", "the", "of", "naïve", "x1", "end."]) + str(rng.randrange(40)) for _ in range(n))


def rows_():
    rng = random.Random(3)
    base = words_of(rng, 60)
    long = "\n".join(words_of(rng, 9) for _ in range(3000))
    texts = [None, "", "   \n", "one", "two words", base, base, base + " tail", words_of(rng, 30), long, "a\nb\nc\nd", "x\na\nb\nc", "a\n\n b \nc", "ünï <|endoftext|> it's ok", "a\nb\nc\na\nb\nc"]
    out = [(i, t) for i, t in enumerate(texts)]
    return [*out, (5, base), (None, base), (40, base), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 0.5, "i", 1, "n", 7, "b", 2) for i, t in rows_()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_bpe_equals_the_library(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    want = []
    for i, t in rows_():
        e = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, e, lib.decode(e, skip_special_tokens=False)))
    both = bpe.encode(docs, path, decoded=True)
    assert set(docs.columns) - {"ids"} < set(both.columns)
    same([(r.doc_id, list(r.ids), r.decoded) for r in both.collect()], want)
    apart = bpe.decode(bpe.encode(docs, path), path)
    same([(r.doc_id, list(r.ids), r.decoded) for r in apart.collect()], want)
    assert bpe.encode(none, path).count() == 0


def test_bpe_refuses_tokenizers_that_keep_white_space(docs):
    with pytest.raises(ValueError, match="white space"):
        bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


def test_token_files_read_back(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    odd_rows = [(100, "a\u00a0\n b \u2003 c"), (101, " lead\u3000 and trail \n\n")]
    odd = spark.createDataFrame(odd_rows, "doc_id long, text string")
    every = docs.select("doc_id", "text").union(odd)
    folder, files = token_files.write(every, path)
    got = token_files.read(spark, folder, files).orderBy("start").collect()
    assert check_files(got, [*rows_(), *odd_rows], lib)
    assert token_files.read(spark, *token_files.write(none, path)).count() == 0


def check_files(got, rows, lib):
    """Rows come in order of doc_id, null first, those of one doc_id in any order; places follow each other."""
    want, start = {}, 0
    for i, t in rows:
        want.setdefault(i, []).append([*lib.encode(t or "", add_special_tokens=False).ids, 0])
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for r in got:
        ids = list(r.ids)
        want[r.doc_id].remove(ids)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return not any(want.values())


def test_token_files_spread_a_doc_id_that_many_rows_share(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(11)
    rows = [(7, words_of(rng, 3)) for _ in range(4000)] + [(None, words_of(rng, 3)) for _ in range(2000)] + [(7, "same")] * 4000 + [(-(2**63), "least"), (2**63 - 1, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    folder, files = token_files.write(table, path)
    assert len(files) >= 4 and max(n for _, n, _ in files) < 0.4 * len(rows)
    got = token_files.read(spark, folder, files).orderBy("start").collect()
    assert check_files(got, rows, Tokenizer.from_file(path))


def test_token_chunks_end_where_the_library_breaks():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, chunks = Tokenizer.from_file(path), token_files.Chunks(path)
    marks = st.lists(st.sampled_from([*"aB1é漢.,;:!?)(\"'-_<>| \t\n\r\x0b\x1c\x85\xa0\u2003", "'s", "'ll", "<|endoftext|>", "don't", "x.", "  "]), max_size=40).map("".join)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(marks | st.text(max_size=20), min_size=1, max_size=5))
    def equal(texts):
        ids, n = chunks.ids(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]

    equal()


def test_token_chunks_of_another_kind_of_tokenizer_go_whole():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    lib, chunks, texts = Tokenizer.from_file(path), token_files.Chunks(path), ["It's ONE, two.", "", "a  b"]
    ids, n = chunks.ids(pa.array(texts, pa.string()))
    assert chunks.whole and [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("cutoff", [1, 2])
def test_language_model_equals_a_plain_one(docs, none, cutoff):
    keep = [(i, t) for i, t in rows_() if i is not None and i % 3]
    score, n = brute.language_model([t for _, t in keep], cutoff)
    model = lm.train(docs.filter("doc_id % 3 <> 0"), cutoff)
    got = lm.score(docs, model).collect()
    assert len(got) == len(rows_())
    by_text = {(r.doc_id, r.text): r for r in got}
    for i, t in rows_():
        r, (tokens, known, base, total) = by_text[i, t], score(t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
        assert r.base_score == pytest.approx(base, abs=1e-6 * tokens)
        assert abs(r.score - total) < 0.001 * tokens
    nothing = lm.score(docs, lm.train(none)).collect()
    assert {(r.train_tokens, r.base_score, r.score) for r in nothing} == {(0, 0.0, 0.0)}
    assert lm.score(none, model).count() == 0


def test_the_scoring_query_keeps_trigrams_seen_once(spark, sf):
    from sparkloom.llm import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    score, n = brute.language_model([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2], cutoff=1)
    got = {r.doc_id: r for r in queries.op1_lm_scoring(spark, sf).collect()}
    for i, t in rows:
        tokens, _, _, total = score(t)
        assert (got[i].n_tokens, got[i].train_tokens) == (tokens, n)
        assert abs(got[i].score - total) < 0.001 * tokens


def test_language_model_is_a_distribution(spark):
    texts = ["a b a c", "a b c", "b c a b", None]
    model = lm.train(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    # after "a b": all words that may follow, an unknown one among them
    ways = [f"a b {w}".strip() for w in ("a", "b", "c", "zz")] + ["a b"]
    got = {r.text: r.score for r in lm.score(spark.createDataFrame([(t,) for t in [*ways, "a b a b"]], "text string"), model).collect()}
    whole, stop = got["a b"], got["a b"]
    assert whole == stop < 0
    assert all(v < 0 for v in got.values())


def test_decontamination_equals_all_windows(spark, docs, none):
    base = rows_()[5][1]
    items = [(1, " ".join(base.split()[5:30])), (2, "alpha one two"), (3, None), (4, "..."), (5, "One!"), (None, "two"), (6, " ".join(base.split()[20:29])), (7, words_of(random.Random(9), 15)), (1, "two words")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.match(docs, table)
    known = [(i, t) for i, t in items if i is not None]
    for r in got.collect():
        n, hit, found = brute.contamination(r.text, known)
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, len(hit), found)
        assert {p for s in r.spans for p in range(s.start, s.stop)} == hit
    clean = {(r.doc_id, r.text) for r in decontaminate.decontaminate(docs, table, max_coverage=0.9).collect()}
    assert (8, rows_()[8][1]) in clean and (3, "one") not in clean
    assert (5, " ".join([*base.split()[:5], "", *base.split()[30:]])) in clean
    assert decontaminate.match(docs, table.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.match(none, table).count() == 0
    assert decontaminate.decontaminate(docs, table).columns == docs.columns


def test_overlapping_items_and_repeats_share_states(spark):
    rng = random.Random(5)
    items = [(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 25)))) for k in range(30)]
    rows = [(k, " ".join(rng.choice("abcd") for _ in range(80))) for k in range(40)]
    got = decontaminate.match(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), n=6)
    for r in got.collect():
        n, hit, found = brute.contamination(r.text, items, 6)
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, len(hit), found)


def test_jaccard_equals_all_pairs(spark, docs, none):
    got = jaccard.jaccard_join(docs).collect()
    want = brute.components([(i, t) for i, t in dict.fromkeys(rows_()) if i is not None])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert len(got) == len(rows_())
    assert jaccard.jaccard_join(none).count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_jaccard_joins_all_rows_of_a_doc_id(spark, parts):
    rows = [(5, "a b c d e f g"), (5, "h i j k l m n"), (3, "a b c d e f g"), (9, "h i j k l m n"), (7, "o p q r s t u")]
    got = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    same([(r.doc_id, r.component_id) for r in got], [(5, 3), (5, 3), (3, 3), (9, 3), (7, 7)])


def test_jaccard_in_a_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for k in range(150):  # edits of one text, some of them far from some others
        own = list(base)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    shared = " ".join(base[:70])
    rows += [(1000 + k, shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(10, 40)))) for k in range(100)]  # a passage that many share
    rng.shuffle(rows)
    want = brute.components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == want


def test_jaccard_gives_all_links_between_different_sets(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = []
    for _ in range(60):  # near copies of one text, some of them equal
        own = list(base)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(40)}"
        texts.append(" ".join(own))
    rows = list(enumerate([*texts, *texts[:9], None, "", "one", "one"]))
    rng.shuffle(rows)
    first = {}
    for i, t in sorted(rows):
        if s := brute.shingles(t):
            first.setdefault(s, i)
    own = list(first.items())
    want = {(min(i, j), max(i, j)) for k, (a, i) in enumerate(own) for b, j in own[k + 1 :] if 100 * len(a & b) >= 80 * len(a | b)}
    got = [tuple(r) for r in jaccard.all_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 60
    assert jaccard.all_links(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 230)] + [(3, 4), (4, 5), (5, 3), (9, 9), (None, 1)]
    got = {r.id: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 7 for k in [7, *range(200, 230)]} | {3: 3, 4: 3, 5: 3}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup_equals_a_plain_one(docs, none):
    every = [(i, t) for i, t in dict.fromkeys(rows_()) if i is not None]
    named = docs.filter("doc_id IS NOT NULL")
    got = line_dedup.line_dedup(named)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    want = brute.deduplicated(every)
    for r in got.collect():
        assert r.text == want[r.doc_id] and r["_lines"] == 7
    assert line_dedup.line_dedup(docs).count() == len(rows_())
    assert line_dedup.line_dedup(none).count() == 0


def test_line_dedup_of_a_window_in_a_third_of_all_rows(spark):
    rng = random.Random(12)
    rows = [(None, "h1\nh2\nh3"), (None, None), (9000, "h2\nh3")]
    for i in range(1200):
        own = [f"l{rng.randrange(400)}" for _ in range(rng.randrange(0, 4))]
        rows.append((i, "\n".join([*own, *(["h1", " h2", "", "h3\r"] if i % 2 else []), f"u{i}"])))
    got = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).filter("doc_id IS NOT NULL").collect()}
    # rows without doc_id come first, so the shared lines stay there
    want = brute.deduplicated([(-1, "h1\nh2\nh3"), *rows[2:]])
    assert {i: r.text for i, r in got.items()} == {i: t for i, t in want.items() if i >= 0}
    assert sum(r.n_removed >= 3 for r in got.values()) >= 600


def test_simhash_edited_texts_and_ties(docs, none):
    rows = sorted(rows_(), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    want = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    got = simhash.edited(docs).collect()
    same([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], want)
    prints = {}
    for r in simhash.fingerprint(docs).collect():
        assert prints.setdefault(r.text or "", r.fingerprint) == r.fingerprint
    assert prints[""] == "0" * 64
    assert simhash.edited(none).count() == 0


def test_simhash_neighbours_are_all_pairs_in_the_radius(spark):
    rng = random.Random(4)
    values = []
    for _ in range(25):
        x = rng.getrandbits(256)
        values.append(x)
        for flips in (1, 2, 3, 4, 5):
            y = x
            for b in rng.sample(range(256), flips):
                y ^= 1 << b
            values.append(y)
    prints = [f"{v:064x}" for v in values]
    got = {tuple(r) for r in simhash.neighbours(spark.createDataFrame([(p,) for p in [*prints, *prints, None]], "fingerprint string"), 4).collect()}
    own = sorted(set(prints))
    want = {(a, b, d) for i, a in enumerate(own) for b in own[i + 1 :] if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 4}
    assert got == want and want


def test_simhash_neighbours_of_edited_texts(spark, sf):
    rng = random.Random(7)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if r.text and len(r.text.split()) >= 150][:40]
    pool = [w for t in texts for w in t.split()]
    rows = []
    for k, t in enumerate(texts):
        for words in (0, 1, 2):
            own = t.split()
            for at in rng.sample(range(len(own)), words):
                own[at] = rng.choice(pool)
            rows.append((3 * k + words, " ".join(own)))
    prints = simhash.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "fingerprint").collect()
    by_id = {r.doc_id: r.fingerprint for r in prints}
    got = {tuple(r) for r in simhash.neighbours(spark.createDataFrame([(p,) for p in by_id.values()], "fingerprint string")).collect()}
    own = sorted(set(by_id.values()))
    want = {(a, b, d) for i, a in enumerate(own) for b in own[i + 1 :] if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= simhash.RADIUS}
    assert got == want
    pairs = {(a, b) for a, b, _ in got}
    copies = [tuple(sorted((by_id[3 * k], by_id[3 * k + w]))) for k in range(len(texts)) for w in (1, 2)]
    assert len(texts) >= 20 and sum(a == b or (a, b) in pairs for a, b in copies) >= 0.95 * len(copies)


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_learn_and_define_odd_cases(spark, docs, none, module, label):
    rng = random.Random(8)
    rows = []
    for k in range(240):
        y = k % 2
        own = words_of(rng, 40).split()
        if y:
            for _ in range(4):
                own[rng.randrange(40)] = rng.choice(["zorg", "zorgish", "blarg!!", "blargen"])
        rows.append((k, " ".join(own), y))
    table = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y, "x") for k, _, y in rows if k % 3] + [(1, 1, "x"), (None, 1, "x"), (2, None, "x")], f"doc_id long, {label} int, text string")
    model = module.train(table, labels, label)
    got = {r.doc_id: r.score for r in module.score(table, model).collect()}
    held = [(got[k], y) for k, _, y in rows if k % 3 == 0]
    assert sum((s >= 0.5) == y for s, y in held) >= 0.9 * len(held)
    odd = module.score(docs, model)
    assert odd.count() == len(rows_()) and odd.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert odd.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert module.score(none, model).count() == 0
    blank = module.score(docs, module.train(docs, labels.limit(0), label)).select("score").distinct().collect()
    assert [r.score for r in blank] == [0.5 if module is quality else 0.0]


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_training_takes_one_row_an_id_and_the_order_of_rows_does_not_matter(spark, module, label):
    rng = random.Random(9)
    rows = [(k % 40, words_of(rng, 12) + (" zorg" if k % 2 else "")) for k in range(160)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], f"doc_id long, {label} int")
    tables = [spark.createDataFrame(r, "doc_id long, text string").repartition(n) for r, n in ((rows, 2), (rows[::-1], 5), (sorted({i: min(t for j, t in rows if i == j) for i, _ in rows}.items()), 1))]
    probe = spark.createDataFrame([(0, "zorg one"), (1, "beta1 gamma2"), (2, None)], "doc_id long, text string")
    got = [sorted((r.doc_id, r.score) for r in module.score(probe, module.train(t, labels, label)).collect()) for t in tables]
    assert got[0] == got[1] == got[2]


def test_rows_without_id_are_not_held_out(spark, tmp_path):
    from sparkloom.llm import queries

    spark.createDataFrame([(None, "a b c"), (1, "a b"), (2, "b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op1_lm_scoring", "op2_toxicity", "op4_quality"):
        assert [r.held_out for r in queries.QUERIES[name](spark, str(tmp_path)).filter("doc_id IS NULL").collect()] == [False], name


@pytest.mark.parametrize("toxic", [[4], [2, 4], [0, 2, 6, 10]])
def test_toxicity_learns_from_labels_of_one_parity(spark, toxic):
    rng = random.Random(8)
    rows = [(k, words_of(rng, 40) + (" zorg zorgish blargen blarg" if k in toxic else "")) for k in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k in toxic)) for k, _ in rows], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(table, toxicity.train(table, labels, "toxic")).collect()}
    assert min(got[k] for k in toxic) > max(v for k, v in got.items() if k not in toxic)


PAGES = [
    ("<p>a<p>b", "a\n\nb"),
    ("<ul><li>one<li>two<ul><li>x</ul></ul><ol start=3><li>c<li>d</ol>after", "- one\n- two\n  - x\n\n3. c\n4. d\n\nafter"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>pineapple<td>12</table>", "Name       Qty\napple      3\npineapple  12"),
    ("<head><title>t</title></head><div>a<div hidden>no</div><span style='display: none'>no</span>b</div><style>.x{display:none}</style><p class='y x'>no</p>", "ab"),
    ("<pre>a\n  b\n</pre>x<br>y<br><br>z", "a\n  b\n\nx\ny\n\nz"),
    ("<script>x<b>\"</p>\"</script>v<!-- c -->w &amp; &lt;z", "vw & <z"),
    ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n  d1\n  d2"),
    ("<table><tr><td>a<table><tr><td>i<td>j</table><td>b</table>", "a\ni  j  b"),
    ("<div>" * 20_000 + "deep", "deep"),
    ("1 < 2 <nav>menu</nav><footer>foot</footer>", "1 < 2\nmenu\nfoot"),
    ("", ""),
    (None, None),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_rendered_pages(html, text):
    assert html is None or html_render.render(html) == text


MORE_PAGES = [
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds", "so x=2 holds"),
    ("a<svg><title>t</title><desc>d</desc><path d='M0 0'/><defs><text>no</text></defs><g><text>One <tspan>label</tspan></text><text>two</text></g>stray</svg>b", "a\nOne label\ntwo\nb"),
    ("<select><option>red<option selected>blue</select>", "red\nblue"),
    ("<textarea>\nx &lt;  y\nz</textarea>after", "x <  y\nz\nafter"),
    ("<style>@media print{.x{display:none}}</style><p class=x>seen", "seen"),
    ("<style>@media (max-width: 600px){.x{display:none} .y{color:red}} .z{display:none}</style><p class=x>seen<p class=z>not", "seen"),
    ("<style>@media screen and (min-width: 600px){.x{display:none}}</style><p class=x>not<p>seen", "seen"),
    ("<style>@media not print{.x{display:none}}</style><p class=x>not<p>seen", "seen"),
    ("<style media=print>.x{display:none}</style><p class=x>seen", "seen"),
]


@pytest.mark.parametrize(("html", "text"), MORE_PAGES)
def test_formulas_fields_labels_and_media_rules(html, text):
    assert html_render.render(html) == text


def test_extraction_over_a_table(spark):
    table = spark.createDataFrame([(k, h, "old") for k, (h, _) in enumerate(PAGES)], "page_id long, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_render.figures(html_render.extract(table)).collect()}
    assert got == {k: (t, len(t or "")) for k, (_, t) in enumerate(PAGES)}
    assert html_render.extract(table.limit(0)).count() == 0


def test_all_visible_words_of_the_sample_pages_come_out(spark, sf):
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.skip, self.words = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "head") and not (tag == "head" and False)

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style", "head")

        def handle_data(self, data):
            if not self.skip:
                self.words += data.split()

    for r in spark.read.parquet(f"{sf}/pages.parquet").limit(30).collect():
        plain = Plain()
        plain.feed(r.html)
        out = html_render.render(r.html)
        assert "".join(w for w in out.split() if w != "-") == "".join(w for w in plain.words if w != "-")


def test_queries_match_their_sql(spark, sf):
    import duckdb

    from sparkloom.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, sf)
        rel = con.execute(sql)
        names = [d[0] for d in rel.description]
        assert sorted(names) == sorted(df.columns)
        same([tuple(r[c] for c in sorted(names)) for r in df.collect()], [tuple(x for _, x in sorted(zip(names, r))) for r in rel.fetchall()])


def test_every_query_covers_its_table(spark, sf):
    from sparkloom.llm import queries

    n, pages = spark.read.parquet(f"{sf}/documents.parquet").count(), spark.read.parquet(f"{sf}/pages.parquet").count()
    for name, f in queries.QUERIES.items():
        assert f(spark, sf).count() == (pages if name == "op6_html_text" else n), name


def without_passages(text, items, n=10):
    """The text without the spans of hit words, and the share of its words that is hit."""
    import re

    total, hit, _ = brute.contamination(text, items, n)
    places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.LOWER))]
    out, at, k = [], 0, 0
    while k < total:
        if k in hit:
            end = k
            while end + 1 in hit:
                end += 1
            out.append(text[at : places[k][0]])
            at, k = places[end][1], end
        k += 1
    return ("".join(out) + (text or "")[at:]) if hit else text, len(hit) / max(total, 1)


def test_pipeline_equals_plain_stages(spark, sf):
    from tokenizers import Tokenizer

    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got, before = [docs], docs.columns
    for name, stage in P.STAGES:
        frame = stage(spark, got[-1], sf)
        assert name == "bpe" or frame.columns == before
        got.append(spark.createDataFrame(frame.collect(), frame.schema))
    texts = [{r.doc_id: r.text for r in g.collect()} for g in got[:-1]]
    # toxicity: what goes is what the models reject
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"), "toxic")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert texts[1] == {i: t for i, t in texts[0].items() if scores[i] < 0.7}
    lines = brute.deduplicated(list(texts[1].items()))
    assert texts[2] == {i: t for i, t in lines.items() if t == texts[1][i] or brute.words(t)}
    groups = brute.components(list(texts[2].items()))
    assert texts[3] == {i: t for i, t in texts[2].items() if groups[i][1] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {i: without_passages(t, items) for i, t in texts[3].items()}
    assert texts[4] == {i: t for i, (t, share) in clean.items() if share <= 0.5}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert {r.doc_id: list(r.ids) for r in got[-1].collect()} == {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in texts[4].items()}
    assert {r.doc_id: r.n_chars for r in got[-2].collect()} == {i: len(t) for i, t in texts[4].items()}


def test_pipeline_stages_on_odd_rows(spark, sf):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(3)
    odd = docs.unionByName(spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-1, "", "en", "s", 0)], docs.schema))
    for name, stage in P.STAGES:
        assert stage(spark, odd, sf).count() >= 2, name
        assert stage(spark, odd.limit(0), sf).count() == 0, name


def test_pipeline_keeps_one_of_copies_without_or_with_the_same_id(spark, sf):
    import corpus_pipeline as P

    one, two = "a b c d e f g h i j k l", "m n o p q r s t u v w x"
    rows = [(1, one), (1, one), (2, two), (None, two), (None, "only here, twice over"), (None, "only here, twice over"), (4, "some text"), (4, "other words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], spark.read.parquet(f"{sf}/documents.parquet").schema)
    got = P.drop_near_copies(spark, docs, sf)
    assert got.columns == docs.columns
    same([(r.doc_id, r.text) for r in got.collect()], [(1, one), (2, two), (None, "only here, twice over"), (4, "some text"), (4, "other words")])
