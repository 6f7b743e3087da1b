from __future__ import annotations

from footfall.llm import fingerprints
from tests.llm.brute import sha


def check(df, rows):
    out = sorted(fingerprints.with_next(df).collect(), key=lambda r: r["doc_id"])
    rows = sorted((d, t or "") for d, t in rows)
    assert [r["doc_id"] for r in out] == [d for d, _ in rows]
    prints = {}
    for k, (row, (_, text)) in enumerate(zip(out, rows, strict=True)):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), sha(edited))
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert prints.setdefault(edited, row["edited_fingerprint"]) == row["edited_fingerprint"]
        own, changed = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (row["fingerprint"], row["edited_fingerprint"]))
        following = out[(k + 1) % len(out)]["fingerprint"]
        following = {following[i : i + 8] for i in range(0, len(following), 8)}
        assert row["near_edited"] == len(own & changed) / len(own | changed)
        assert row["near_next"] == len(own & following) / len(own | following)
    return out


def test_given_documents(docs, rows):
    out = check(docs, rows)
    long = [r for r in out if r["n_chars"] > 500]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)


def test_odd_documents(odd, odd_rows):
    check(odd, [r[:2] for r in odd_rows])


def test_one_document_follows_itself(spark):
    df = spark.createDataFrame([(5, "the cat of a house and the dog in a garden")], "doc_id long, text string")
    (row,) = fingerprints.with_next(df).collect()
    assert row["near_next"] == 1.0


def test_common_words_anchor_the_chains(spark):
    frame = "Menu Login Contact Imprint Privacy Search "
    story = "the quick fox jumped over a lazy dog while the old owner slept in the warm sun of summer days and the birds sang of distant lands"
    rows = [(1, story), (2, frame + story), (3, "the grey horse and a white barn of stone were on the long road to a village in the hills where the river bends")]
    out = {r["doc_id"]: r for r in fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1]["near_next"] == 1.0 and out[2]["near_next"] == 0.0


def test_likeness_is_pruned_by_length():
    import numpy as np

    a, b = np.arange(10), np.arange(20)
    assert fingerprints.likeness(a, b) == 0.5 and fingerprints.likeness(a, b, 0.75) == 0.0
    assert fingerprints.likeness(a[:0], a[:0]) == 0.0 and fingerprints.likeness(a, a) == 1.0


def test_repeated_null_ids_and_empty(repeated, empty, odd_rows):
    out = fingerprints.with_next(repeated).collect()
    assert len(out) == 2 * len(odd_rows) + 4 and sum(r["doc_id"] is None for r in out) == 4
    assert fingerprints.with_next(empty).collect() == []


def test_many_rows_without_or_with_one_id(spark, docs, rows):
    """A third of the rows lacks an id and a third shares one: they are spread, and each meets its successor."""
    made = [((None, 70, d)[d % 3], t or "") for d, t in rows]
    df = spark.createDataFrame(made, "doc_id long, text string")
    dealt, n = fingerprints._dealt(df, 16)
    placed = dealt.collect()
    parts = [r["part"] for r in placed]
    assert len(placed) == len(made) and max(parts) < n and max(parts.count(p) for p in set(parts)) < len(made) / 4
    order = sorted(placed, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["mark"], r["text"]))
    assert [r["part"] for r in order] == sorted(parts)
    want = []
    for k, row in enumerate(order):
        text, after = row["text"], order[(k + 1) % len(order)]["text"]
        half = len(text) // 2
        want.append((row["doc_id"] is not None, row["doc_id"] or 0, len(text), sha(text[: len(text) - half] + after[:half])))
    out = [(r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in fingerprints.with_next(df).collect()]
    assert sorted(out) == sorted(want)


def test_near_pairs_are_all_pairs(docs, odd):
    for df in (docs, odd):
        members = fingerprints.classes(df)
        sets = {bytes(r["class"]): set(r["signatures"]) for r in members.collect()}
        want = set()
        names = sorted(sets)
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                if len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b]):
                    want.add(frozenset((a, b)))
        out = fingerprints.near_pairs(members).collect()
        assert {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in out} == want and len(out) == len(want)


def test_lists_of_a_common_signature_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "LIST_ROWS", 10)
    sets = [sorted({7, 100 + k // 2, *([500 + k] if k % 2 else [])}) for k in range(200)] + [[7]]
    members = spark.createDataFrame([(k, bytes([k]), s) for k, s in enumerate(sets)], "doc_id long, class binary, signatures array<long>")
    for side in fingerprints._sides(members, 0.6):
        assert max(r["count"] for r in side.where("s = 7").groupBy("s", "band", "i", "j").count().collect()) < 60
    out = fingerprints.near_pairs(members, 0.6).collect()
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and len({*a} & {*b}) >= 0.6 * len({*a} | {*b})}
    assert {tuple(sorted((r["a"][0], r["b"][0]))) for r in out} == want and len(out) == len(want) == 100
