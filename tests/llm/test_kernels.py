import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm import elias_fano, kernels as K, quality, simhash, token_files
from tests.llm import brute

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("aB é\t\n\x0b .z0")), max_size=40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    hashes, counts = K.word_hashes(column)
    want = [brute.words(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    by_word, by_hash = {}, {}
    for w, h in zip(flat, hashes.tolist()):
        assert by_word.setdefault(w, h) == h
        assert by_hash.setdefault(h, w) == w


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingle_sets_have_the_size_of_the_sets(texts):
    codes, sizes = K.shingle_sets(*K.word_hashes(pa.array(texts, pa.string())), 3)
    assert sizes.tolist() == [len(brute.shingles(t, 3)) for t in texts]
    assert len(codes) == sizes.sum()


def test_slices_keep_all_rows_and_long_ones_alone():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "", "c" * 5]})
    parts = list(K.slices(batch, "text", 20))
    assert [r for p in parts for r in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(sum(len(x or "") for x in p.column("text").to_pylist()) for p in parts if p.num_rows > 1) <= 20


@pytest.mark.parametrize(("n", "u"), [(0, 5), (1, 1), (1000, 1000), (5000, 10**9), (300_000, 400_000), (2000, 3), (70, 2**45)])
def test_elias_fano_access_and_successor(n, u):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, u, n))
    s = elias_fano.Sequence(elias_fano.encode(v, u))
    assert (s.access(np.arange(n)) == v).all()
    q = np.concatenate([v, rng.integers(0, u, 2000), [0, u - 1]]).astype(np.uint64)
    at, hit = s.successor(q)
    assert (at == np.searchsorted(v, q)).all()
    assert (hit == np.isin(q, v)).all()


@pytest.mark.parametrize("top", [1 << 40, (1 << 62) + 1])
def test_elias_fano_successor_where_values_lie_close(top):
    rng = np.random.default_rng(3)
    near = [np.sort(rng.choice(30_000, n, replace=False)) for n in (1, 2, 3, 700, 9000)]
    v = np.concatenate([a + (k << 36) for k, a in enumerate(near)] + [[top - 1] * 3])
    for few in (v, v[:2], v[-3:]):
        s = elias_fano.Sequence(elias_fano.encode(few, top))
        q = np.concatenate([v, v + 1, rng.integers(0, top, 500), rng.integers(0, 30_000, 500) + (4 << 36)]).astype(np.uint64)
        q = q[q < top]
        at, hit = s.successor(q)
        assert (at == np.searchsorted(few.astype(np.uint64), q)).all()
        assert (hit == np.isin(q, few.astype(np.uint64))).all()
        assert (s.access(np.arange(len(few))) == few.astype(np.uint64)).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_variable_length_code_round_trip(values):
    a = np.array(values, np.uint32)
    assert token_files.unpack(*token_files.pack(a), len(a)).tolist() == values


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60_000), max_size=9), max_size=9))
def test_token_file_round_trip(rows):
    counts = np.array([len(r) for r in rows], np.int64)
    ids = np.array([i for r in rows for i in r], np.int64)
    names, n, back = token_files.parse_file(token_files.file_bytes(np.arange(len(rows)), counts, ids))
    assert (names.tolist(), n.tolist(), back.tolist()) == (list(range(len(rows))), counts.tolist(), ids.tolist())


@settings(max_examples=40, deadline=None)
@given(TEXTS)
def test_simhash_equals_plain_votes(texts):
    got = simhash.fingerprints(pa.array(texts, pa.string()))
    for row, text in zip(got, texts):
        words = brute.words(text)
        codes = K.word_hashes(pa.array([text], pa.string()))[0].tolist()
        lengths = [len(w.encode()) for w in words]
        votes = [0] * simhash.BITS
        for k in range(len(words) - 2 if len(words) >= 3 else min(len(words), 1)):
            term = codes[k]
            for c in codes[k + 1 : k + 3]:
                term = brute.mixed(term * 0xD6E8FEB86659FD93 + c)
            weight = min(max(sum(lengths[k : k + 3]) // 4, 1), 4)
            for part, seed in enumerate(simhash._SEEDS.tolist()):
                bits = brute.mixed(term ^ seed)
                for b in range(64):
                    votes[part * 64 + b] += weight if bits >> b & 1 else -weight
        assert np.unpackbits(row).tolist() == [int(v > 0) for v in votes]


@pytest.mark.parametrize("l1", [0.02, 1.0])  # the larger one holds weights at zero
def test_ftrl_equals_a_plain_loop(l1):
    rng = np.random.default_rng(5)
    vectors, labels = [], []
    for k in range(60):
        at = np.sort(rng.choice(40, rng.integers(1, 9), replace=False)).astype(np.int64)
        vectors.append((np.append(at, 1 << quality.BITS), np.append(rng.random(len(at)), 1.0)))
        labels.append(int(3 in at or k % 7 == 0))
    got = quality.ftrl(vectors, labels, l1=l1)
    want = brute.ftrl([dict(zip(at.tolist(), x.tolist())) for at, x in vectors], labels, np.random.default_rng(7), 4, 0.5, 1.0, l1, 0.01)
    places = sorted(want)
    assert np.allclose(got[places], [want[k] for k in places], rtol=1e-5, atol=1e-7)
    assert set(np.flatnonzero(got).tolist()) <= set(places) and any(want.values()) and (l1 < 1 or not all(want.values()))
