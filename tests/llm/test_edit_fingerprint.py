"""Fingerprints: the contract, and that edit distance shows in them."""

import hashlib
import random

import numpy as np

from blotter.llm import edit_fingerprint as ef
from tests.conftest import SF001
from tests.llm.common import SCHEMA, edge_docs, ordered


def check(docs, rows):
    """Rows against brute-force edited texts of the ordered documents."""
    docs = ordered(docs)
    want = []
    for k, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in rows), key=repr) == sorted(want, key=repr)
    for r in rows:
        a, b = bytes.fromhex(r.fingerprint), bytes.fromhex(r.edited_fingerprint)
        assert len(a) == len(b) == ef.SLOTS
        assert r.near_edited == sum(x == y for x, y in zip(a, b)) / ef.SLOTS
        assert 0 <= r.near_next <= 1


def test_query_on_a_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = ef.query(spark, SF001).collect()
    check(docs, rows)
    prints, texts = {r.doc_id: r.fingerprint for r in rows}, {}
    for doc_id, text in docs:
        assert texts.setdefault(text, prints[doc_id]) == prints[doc_id]
    following = dict(zip(sorted(prints), sorted(prints)[1:]))
    for r in rows:
        if r.doc_id in following:
            a, b = bytes.fromhex(r.fingerprint), bytes.fromhex(prints[following[r.doc_id]])
            assert r.near_next == sum(x == y for x, y in zip(a, b)) / ef.SLOTS


def test_several_ranges_give_the_same_rows(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    one = sorted(map(tuple, ef.fingerprints(docs).collect()))
    monkeypatch.setattr(ef, "RANGE_TEXT", 20_000)
    assert sorted(map(tuple, ef.fingerprints(docs.repartition(7)).collect())) == one


def test_edge_rows(spark):
    docs = edge_docs(spark)
    check([(r.doc_id, r.text) for r in docs.collect()], ef.fingerprints(docs).collect())
    assert ef.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    only = ef.fingerprints(docs.filter("doc_id = 4")).first()
    assert only.near_next == 1.0


def _prints(*texts):
    return ef.Fingerprinter().fingerprints([ef.classes(t) for t in texts])


def test_likeness_falls_with_edits():
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(6000))

    def altered(n):
        chars = list(base)
        for _ in range(n):
            at = rng.randrange(len(chars))
            rng.choice([lambda: chars.pop(at), lambda: chars.insert(at, "q"), lambda: chars.__setitem__(at, "z")])()
        return "".join(chars)

    near, some, other = altered(10), altered(150), "".join(rng.choice("abcdefgh ijklmnop") for _ in range(6000))
    prints = _prints(base, base, near, some, other)
    like = [float((prints[0] == p).mean()) for p in prints[1:]]
    assert like[0] == 1.0 and like[1] > 0.8 and like[1] > like[2] > like[3] and like[3] < 0.2


def test_walk_covers_the_whole_text():
    base = "abcdefghij" * 1000
    for at in range(0, len(base), 977):
        changed = base[:at] + "Z" * 600 + base[at + 600:]
        prints = _prints(base, changed)
        assert (prints[0] != prints[1]).any()


def test_a_replaced_end_shows_in_short_texts():
    rng = random.Random(3)

    def noise(n):
        return "".join(rng.choice("abcdefgh ijklmnop") for _ in range(n))

    for n in (200, 255, 300, 511):
        for share in (2, 4):
            like = []
            for _ in range(40):
                text = noise(n)
                a, b = _prints(text, text[:n - n // share] + noise(n // share))
                like.append(float((a == b).mean()))
            assert np.mean(like) < 1.1 - 1 / share, (n, share, np.mean(like))


def test_walks_reach_the_end_of_their_segment():
    rng = random.Random(8)
    sizes = np.array([1, 17, 255, 256, 300, 511, 511])
    joined = ef.classes("".join(rng.choice("abcdefgh") for _ in range(sizes.sum())))
    begin = np.cumsum(sizes) - sizes
    out, row_of, steps = ef.Fingerprinter().written(joined, begin, sizes)
    assert out[steps, np.arange(len(steps))].max() == 0
    for b, n, row in zip(begin, sizes, row_of):
        # every character was written down at least once, in order
        it = iter(out[:steps[row], row].tobytes())
        assert all(c in it for c in joined[b:b + n].tobytes())


def test_segments_cover_every_character_once():
    rng = random.Random(1)
    texts = ["", "a", "ab" * 2000, "z" * 5000, "", "".join(rng.choice("abcd efg") for _ in range(9000)), "x" * 511, "y" * 512]
    coded = [ef.classes(t) for t in texts]
    begin, names, first = ef.segments(coded)
    lengths = np.append(begin[1:], sum(map(len, texts))) - begin
    assert [int(lengths[a:b].sum()) for a, b in zip(first[:-1], first[1:])] == [len(t) for t in texts]
    assert lengths.max() < 2 * ef.SEGMENT
    for a, b in zip(first[:-1], first[1:]):
        assert len(set(names[a:b].tolist())) == b - a
    # a text has the same segments whatever else is in its batch
    alone, own, _ = ef.segments([coded[5]])
    assert own.tolist() == names[first[5]:first[6]].tolist()


def test_an_inserted_passage_leaves_the_rest_alike():
    rng = random.Random(6)

    def noise(n):
        return "".join(rng.choice("abcdefgh ijklmnop") for _ in range(n))

    for inserted in (1, 50, 200, 300, 500):
        found = 0
        for _ in range(30):
            text, header = noise(20_000), noise(inserted)
            prints = _prints(text, header + text, text[:300] + header + text[300:])
            found += ef.likeness(prints[:1], prints[1:2])[0] >= ef.LIKENESS
            found += ef.likeness(prints[:1], prints[2:])[0] >= ef.LIKENESS
        assert found >= 57, (inserted, found)


def test_near_links_find_planted_copies(spark):
    rng = random.Random(9)
    rows = []
    for k in range(60):
        text = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(3000))
        rows += [(2 * k, text, "s"), (2 * k + 1, text[:1500] + "x" + text[1500:], "s")]
    docs = edge_docs(spark, rows)
    links = {(r.doc_id, r.near_id) for r in ef.near_links(ef.fingerprints(docs)).collect()}
    planted = {(2 * k + 1, 2 * k) for k in range(60)}
    assert links <= planted and len(links & planted) >= 54
    assert np.all([a > b for a, b in links])


def test_no_link_of_a_crowd_is_lost(spark):
    """600 pairs of near copies among 1,200 texts of one template, each with
    its own part: every pair is linked, whoever heads the crowd."""
    rng = random.Random(22)

    def some(n):
        return "".join(rng.choice("abcdefgh ijklmnop") for _ in range(n))

    template = [some(390) for _ in range(8)]
    rows = []
    for k in range(600):
        text = "".join(t + some(110) for t in template)
        rows += [(2 * k, text), (2 * k + 1, text[:2000] + "y" + text[2000:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ef.near_classes(ef.fingerprints(docs)).select("doc_id", "fingerprint", "class_id").collect()
    classes = {r.doc_id: r.class_id for r in found}
    prints = {r.doc_id: np.frombuffer(bytes.fromhex(r.fingerprint), np.uint8) for r in found}
    near = [k for k in range(600) if (prints[2 * k] == prints[2 * k + 1]).mean() >= ef.LIKENESS]
    assert len(near) >= 590
    assert all(classes[2 * k] == classes[2 * k + 1] for k in near)
    # no link but of likeness: classes are the components of the confirmed pairs
    values = np.stack([prints[k] for k in range(1200)])
    linked = (values[:, None] == values[None]).mean(axis=2) >= ef.LIKENESS
    for k in range(1200):
        assert (linked[k] & (np.array([classes[j] for j in range(1200)]) == classes[k])).sum() >= 1 + (classes[k] != k)


def test_bands_over_many_cells_link_the_same(spark, monkeypatch):
    rng = random.Random(23)
    base = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(4000))
    rows = [(k, base[:60 * k] + "z" * (k % 3) + base[60 * k:]) for k in range(60)]
    prints = ef.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    one = {(r.doc_id, r.class_id) for r in ef.near_classes(prints).collect()}
    monkeypatch.setattr(ef, "CELL", 7)
    assert {(r.doc_id, r.class_id) for r in ef.near_classes(prints).collect()} == one


def test_fingerprint_by_one_walk_per_character():
    """The vectorised walk writes what a character-by-character walk writes."""
    maker, rng = ef.Fingerprinter(), random.Random(24)
    texts = ["".join(rng.choice("abc dé\U0001f600") for _ in range(n)) for n in (0, 1, 5, 300, 2000)]
    coded = [ef.classes(t) for t in texts]
    begin, names, first = ef.segments(coded)
    joined = np.concatenate(coded)
    lengths = np.append(begin[1:], len(joined)) - begin
    out, row_of, steps = maker.written(joined, begin, lengths)
    for k, (b, n) in enumerate(zip(begin.tolist(), lengths.tolist())):
        segment, at, walked = joined[b:b + n], 0, []
        for j in range(len(maker.coins)):
            if at >= n:
                break
            walked.append(int(segment[at]))
            at += int(maker.coins[j][segment[at]])
        assert walked == out[:len(walked), row_of[k]].tolist() and len(walked) == steps[row_of[k]]
        assert not out[len(walked):, row_of[k]].any()
