import random

from ledgerline.llm import simhash as H

from . import brute


def test_fingerprints_match_brute_force(spark, docs, odd):
    for df in (docs, odd):
        got = sorted(((r["text"] or "", r["fp"] & (1 << 64) - 1) for r in H.fingerprints(df.select("text"), "text", ["text"]).collect()))
        assert got == sorted((t or "", brute.fingerprint(t)) for (t,) in df.select("text").collect())


def test_shingles_beyond_a_byte_of_counts(spark):
    text = " ".join(random.Random(1).choice("abcdefgh") for _ in range(3000))
    df = spark.createDataFrame([(text,)], "text string")
    assert H.fingerprints(df, "text", []).first()["fp"] & (1 << 64) - 1 == brute.fingerprint(text)


def _components(spark, fps):
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id bigint, fp bigint")
    found = {r["fp"] & (1 << 64) - 1: r["component_id"] for r in H.near_duplicate_classes(df).collect()}
    return [found[f] for f in fps]


def test_components_match_brute_force(spark):
    rnd = random.Random(3)
    fps = [rnd.getrandbits(64) for _ in range(150)]
    for _ in range(200):  # chains and clusters of flips of 1 to 3 bits
        f = rnd.choice(fps)
        for _ in range(rnd.randint(1, 3)):
            f ^= 1 << rnd.randrange(64)
        fps.append(f)
    fps += [0, 1, (1 << 64) - 1, fps[0], fps[1]]
    assert _components(spark, fps) == brute.components(fps)


def test_long_chain_and_full_sixteen_bits(spark):
    chain, f = [1 << 40], 1 << 40
    for i in range(0, 40, 2):
        f ^= 3 << i
        chain.append(f)
    assert set(_components(spark, chain)) == {0}
    low = list(range(4096))
    assert set(_components(spark, low)) == {0}


def test_query_shape_and_odd_rows(spark, odd, none):
    rows = H.components(odd).collect()
    assert len(rows) == odd.count() and all(r["fp"] is not None for r in rows)
    zero = [r for r in rows if r["fp"] == 0]
    assert len(zero) == 3 and len({r["component_id"] for r in zero}) == 1
    assert H.components(none).count() == 0


def test_deduplicate_keeps_one_each(spark, docs, odd, none):
    for df in (docs, odd):
        kept = H.deduplicate(df)
        assert kept.columns == df.columns
        ids = [r["text"] for r in kept.select("text").collect()]
        fps = [brute.fingerprint(t) for t in ids]
        assert len(set(brute.components(fps))) == len(fps)  # none left are near
        every = [brute.fingerprint(t) for (t,) in df.select("text").collect()]
        assert len(fps) == len(set(brute.components(every)))
    assert H.deduplicate(none).count() == 0


def test_links_equal_a_literal_tally_of_positional_bytes(spark, docs):
    """Posting lists of one byte each, shared bytes counted pair by pair."""
    fps = [brute.fingerprint(r["text"]) for r in docs.select("text").collect()]
    rnd = random.Random(8)
    fps += [f ^ 1 << rnd.randrange(64) for f in fps]
    fps += [f ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) for f in fps]
    fps = sorted(set(fps))
    postings = {}
    for i, f in enumerate(fps):
        for at in range(8):
            postings.setdefault((at, f >> 8 * at & 255), []).append(i)
    tally = {}
    for members in postings.values():
        for k, i in enumerate(members):
            for j in members[:k]:
                tally[j, i] = tally.get((j, i), 0) + 1
    for max_bits in (1, 2, 3):
        near = {p for p, n in tally.items() if n >= 8 - max_bits and (fps[p[0]] ^ fps[p[1]]).bit_count() <= max_bits}
        assert near
        rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
        found = [(r["a"], r["b"]) for r in H.links(rows, max_bits=max_bits).collect()]
        assert all(a < b for a, b in found) and len(set(found)) == len(found)
        place = {f - (1 << 64) if f >> 63 else f: i for i, f in enumerate(fps)}
        assert grouped(len(fps), near) == grouped(len(fps), {(place[a], place[b]) for a, b in found})


def grouped(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_long_lists_are_compared_whole(spark):
    """Thousands of fingerprints in one list, in clusters of up to four bits."""
    rnd, fps = random.Random(5), set()
    for _ in range(300):
        f = rnd.getrandbits(32) << 32 | 77
        for _ in range(10):
            f ^= 1 << rnd.randrange(32, 64)
            fps.add(f)
    fps = sorted(fps)
    assert len(fps) > 2 * H.LONG
    near = {(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= 4}
    place = {f - (1 << 64) if f >> 63 else f: i for i, f in enumerate(fps)}
    found = H.links(spark.createDataFrame([(k,) for k in place], "fp bigint"), max_bits=4).collect()
    assert grouped(len(fps), near) == grouped(len(fps), {(place[r["a"]], place[r["b"]]) for r in found})


def word_prints(text):
    import xxhash

    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in set(brute.WORD.findall((text or "").translate(brute.LOWER)))]
    out = []
    for _ in range(H.WORD_SETS):
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
        m = (1 << 64) - 1
        h = [x + 0x9E3779B97F4A7C15 & m for x in h]
        h = [(x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m for x in h]
        h = [(x ^ x >> 27) * 0x94D049BB133111EB & m for x in h]
        h = [x ^ x >> 31 for x in h]
    return out


def near_copies(texts):
    """Smallest index reachable for each text under the rule of the pipeline's stage."""
    fps, words = [brute.fingerprint(t) for t in texts], [word_prints(t) for t in texts]
    near = lambda i, j: fps[i] == fps[j] or (fps[i] ^ fps[j]).bit_count() <= H.VERIFY_BITS and any((a ^ b).bit_count() <= H.WORD_BITS for a, b in zip(words[i], words[j]))
    return grouped(len(texts), [(i, j) for j in range(len(texts)) for i in range(j) if near(i, j)])


def test_word_sets_find_copies_with_changed_words(spark, docs, odd):
    rnd, texts = random.Random(6), [r["text"] for r in docs.select("text").collect() if len(r["text"].split()) >= 60][:60]
    planted = []
    for k, t in enumerate(texts):
        w = t.split()
        for _ in range(len(w) // 60):
            w[rnd.randrange(len(w))] = f"new{k}"
        planted.append(" ".join(w))
    texts = texts + planted + [r["text"] for r in odd.select("text").collect()]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id bigint, text string, words_0 string")
    kept = H.deduplicate(df, word_bits=H.WORD_BITS)
    want = near_copies(texts)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))
    caught = sum(want[60 + i] <= i for i in range(60))
    assert caught >= 54, caught
