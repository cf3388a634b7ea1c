import re

from tests.llm.cases import documents, frame, lower, plain, prose, words
from viewtide.llm import sentence_spans as ss


def sentences(text):
    out = []
    found = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    for k, (a, _, word) in enumerate(found):
        before = found[k - 1] if k else None
        ends = before and before[2][:-1] if before and len(before[2]) > 1 and before[2][-1] in "\"')]" else before and before[2]
        if not before or ends[-1] in ".!?" or "\n" in text[before[1] : a]:
            out.append([])
        out[-1].append((a, lower(word)))
    return out


def brute(rows):
    """Cut texts by id and text; rows that repeat both count once."""
    docs = {(r[0] is None, r[0] or 0, r[1]): sentences(r[1]) for r in rows}
    runs = {}
    for doc, own in docs.items():
        n, k = 0, len(own)
        while k > 0 and (n < ss.WORDS or len(own) - k < ss.SENTENCES):
            n, k = n + len(own[k - 1]), k - 1
        if n >= ss.WORDS and len(own) - k >= ss.SENTENCES:
            runs.setdefault(tuple(w for s in own[k:] for _, w in s), []).append((doc, k, len(own)))
        for k in range(len(own)):
            n, stop = 0, k
            while stop < len(own) and (n < ss.WORDS or stop - k < ss.SENTENCES):
                n, stop = n + len(own[stop]), stop + 1
            stops = [stop] if n >= ss.WORDS and stop - k >= ss.SENTENCES else []
            for end in stops + [k + 1] * (len(own[k]) >= ss.LONG_SENTENCE):
                runs.setdefault(tuple(w for s in own[k:end] for _, w in s), []).append((doc, k, end))
    return docs, runs


def test_removal_matches_brute_force(spark):
    passage = prose(71, 60)
    rows = [(k, prose(80 + k, 40) + "\n" + passage + "\n" + prose(90 + k, 30), "en", "a") for k in range(1, 6)]
    rows += [(9, "A b c.\nA b c.\n" * 12 + "end", "en", "a"), (10, None, "en", "a"), (11, " ".join(["long"] * 70), "en", "a")]
    rows += [(12, "Start. " + " ".join(["long"] * 70), "en", "a"), (13, "", "en", "a")]
    docs, runs = brute(rows)
    cover = {doc: set() for doc in docs}
    for places in runs.values():
        first = min(places, key=lambda p: (p[0][0], p[0][1], p[1]))
        for doc, k, end in places:
            if (doc, k) != first[:2]:
                cover[doc] |= set(range(k, end))
    made = ss.remove_repeats(plain(spark, rows)).collect()
    for r in made:
        doc = (False, r.doc_id, next(x[1] for x in rows if x[0] == r.doc_id))
        own = docs[doc]
        edges = [s[0][0] for s in own] + [len(doc[2] or "")]
        want = doc[2] and doc[2][: edges[0]] + "".join(
            doc[2][edges[k] : edges[k + 1]] for k in range(len(own)) if k not in cover[doc]
        )
        assert (r.n_sentences, r.n_removed, r.text) == (len(own), len(cover[doc]), want)
    by_id = {r.doc_id: r for r in made}
    inner = " ".join(words(passage)[8:-8])
    assert inner in " ".join(words(by_id[1].text))
    assert not any(inner in " ".join(words(by_id[k].text)) for k in range(2, 6))
    assert by_id[3].first_docs == [1] and by_id[1].first_docs == []


def test_awkward_rows(spark):
    docs = frame(spark)
    made = ss.remove_repeats(docs)
    assert made.columns == [*docs.columns, "n_sentences", "n_removed", "first_docs"]
    rows = made.collect()
    assert len(rows) == len(documents())
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    # An exact copy loses all that runs cover; rows that repeat id and text are cut alike.
    assert by_id[1][0].n_removed == 0 and by_id[2][0].n_removed == by_id[2][0].n_sentences
    assert [r.n_removed for r in by_id[17]] == [0, 0]
    assert {(r.text, r.n_sentences) for r in by_id[None]} >= {(None, 0)}
    assert by_id[4][0].text == next(r[1] for r in documents() if r[0] == 4)
    assert ss.remove_repeats(frame(spark, [])).collect() == []


def test_passages_go_to_their_ends(spark):
    """Long sentences before short ones, against a brute force over all runs."""
    import random

    rng, rows = random.Random(5), []

    def some(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) + ". "

    passages = ["".join(some(n) for n in sizes) for sizes in ((30, 30, 2, 3), (3, 2, 30, 30, 1, 1, 1), (4, 4, 4), (12, 1, 1), (60,), (2, 3))]
    for k in range(24):
        own = [some(rng.randrange(1, 25)) for _ in range(3)]
        rows.append((k, own[0] + passages[k % 6] + own[1] + passages[rng.randrange(6)] + own[2], "en", "a"))
    docs = {(r[0], r[1]): sentences(r[1]) for r in rows}
    runs = {}
    for doc, own in docs.items():
        for k in range(len(own)):
            for end in range(k + 1, len(own) + 1):
                run = tuple(w for s in own[k:end] for _, w in s)
                if len(run) >= (ss.LONG_SENTENCE if end == k + 1 else ss.WORDS):
                    runs.setdefault(run, []).append((doc, k, end))
    cover = {doc: set() for doc in docs}
    for places in runs.values():
        for doc, k, end in sorted(places)[1:]:
            cover[doc] |= set(range(k, end))
    made = ss.remove_repeats(plain(spark, rows)).collect()
    assert {r.doc_id: r.n_removed for r in made} == {doc[0]: len(x) for doc, x in cover.items()}
    for r in made:
        own = docs[r.doc_id, next(x[1] for x in rows if x[0] == r.doc_id)]
        assert words(lower(r.text)) == [w for k, s in enumerate(own) if k not in cover[r.doc_id, rows[r.doc_id][1]] for _, w in s]
