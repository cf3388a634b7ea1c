import hashlib
import math
import random
import re
import time

import pytest

from tests.llm.cases import documents, frame, lower, plain, prose
from viewtide.llm import pii

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and pii.luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
]
TEXTS = [
    "é mail a.b+c@x-y.co.uk, d@e and f@g.h.i@j.k l@@m.n @o.p",
    "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.2.3.04 12345.1.2.3 9.9.9",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 0000000000000 5500005555555559 1 2 3",
    "call +44 20 7946 0958 or +1 (555) 010-9999. +12 +49.....5 ++33 1 23 45 67 89!",
    "a" * 4000 + "1" * 4000 + "@" + "b" * 10,
    "x@y.z" * 50 + " 😀 1.1.1.1",
]


def brute(text):
    return [
        (kind, m.start(), m.end()) for kind, p, good in PATTERNS for m in re.finditer(p, text or "") if good(m[0])
    ]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def rows_of(texts):
    return [(50 + k, text, "en", "a", 1, 0.5, "v", 7, "k", 3) for k, text in enumerate(texts)] + documents()


def test_digest_matches_brute_force(spark):
    rows = rows_of(TEXTS)
    made = pii.scan(frame(spark, rows)).collect()
    want = []
    for row in rows:
        spans = brute(row[1])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == kind for s in spans) for kind in pii.KINDS]
        want.append((str(row[0]), *counts, hashlib.sha256(text.encode()).hexdigest(), text))
    have = [(str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in made]
    assert sorted(have) == sorted(want)


def secretive():
    """An address with one telling term, a common word beside it, and copies of one passage."""
    rows = [(k, f"{prose(k, 12)} zebra37 boss@corp.example.com common {prose(90 + k, 12)}", "en", "a") for k in range(6)]
    rows += [(20 + k, f"{prose(40 + k, 30)} common {prose(60 + k, 30)}", "en", "a") for k in range(30)]
    rows += [(60 + k, "copied passage with rareword me@one.example.org beside it", "en", "a") for k in range(8)]
    return rows + [(90, f"{prose(7, 9)} Zebra37, é zebra37 {prose(8, 9)}", "en", "a")]


def test_telling_terms_are_found_everywhere(spark):
    docs = plain(spark, secretive())
    terms = pii.revealing_terms(docs, generalise=0.9)
    shares = {r.term: r.disclosure for r in terms.collect()}
    [zebra, common, rare] = pii.term_hashes(["zebra37 common rareword"])
    # Six of its seven documents name the address; the eight copies are one text of 38.
    assert shares[zebra] == pytest.approx(1 + math.log(6 / 7) / math.log(38 / 6))
    assert common not in shares and rare not in shares
    rows = {r.doc_id: r for r in pii.digest(pii.find_personal(docs, terms)).collect()}
    text = secretive()[-1][1]
    places = [m.span() for m in re.finditer("(?i)zebra37", text)]
    assert rows[90].spans == ",".join(f"term:{a}:{b}" for a, b in places)
    assert all(rows[k].n_term >= 1 and rows[k].n_email == 1 for k in range(6))
    assert all(rows[20 + k].spans == "" for k in range(30))


@pytest.mark.parametrize("copied", [0, 1, 30])
def test_copies_do_not_unmark_a_telling_term(spark, copied):
    """Of the documents with the term, one is copied 1,000 times: beside the entity, or away from it."""
    rows = [(k, f"{prose(k, 12)} zebra37 boss@corp.example.com common {prose(90 + k, 12)}", "en", "a") for k in range(30)]
    rows += [(30, f"{prose(7, 9)} zebra37 {prose(8, 9)}", "en", "a")]
    rows += [(40 + k, f"{prose(40 + k, 30)} common {prose(60 + k, 30)}", "en", "a") for k in range(300)]
    share = lambda rows: {r.term: r.disclosure for r in pii.revealing_terms(plain(spark, rows), generalise=0.9).collect()}
    [zebra, common] = pii.term_hashes(["zebra37 common"])
    made = share(rows + [(1000 + k, *rows[copied][1:]) for k in range(1000)])
    assert made[zebra] == pytest.approx(1 + math.log(30 / 31) / math.log(331 / 30))
    assert common not in made


def test_a_passage_in_many_documents_does_not_unmark_a_telling_term(spark):
    """Two contexts, and a third that hundreds of different documents repeat."""
    passage = "please write now to our zebra37 desk boss@corp.example.com any time that you like it"
    rows = [(k, f"{prose(k, 12)} zebra37 boss@corp.example.com {prose(90 + k, 12)}", "en", "a") for k in range(2)]
    rows += [(10 + k, f"{prose(200 + k, 30)} {passage} {prose(600 + k, 30)}", "en", "a") for k in range(200)]
    rows += [(400 + k, prose(1200 + k, 30), "en", "a") for k in range(200)]
    [zebra] = pii.term_hashes(["zebra37"])
    made = {r.term: r.disclosure for r in pii.revealing_terms(plain(spark, rows)).collect()}
    assert made[zebra] == pytest.approx(1)


def test_names_of_an_address_are_protected_unless_they_are_common(spark):
    rows = [(1, f"{prose(1, 20)} write to zorblaxa.common.77@mail.example.com or ask ZORBLAXA, common", "en", "a")]
    rows += [(10 + k, f"{prose(10 + k, 30)} common {prose(80 + k, 20)}", "en", "a") for k in range(40)]
    docs = plain(spark, rows)
    rows = {r.doc_id: r for r in pii.scan(docs).collect()}
    text = docs.filter("doc_id = 1").first().text
    at = text.index("ZORBLAXA")
    mail = re.search(r"\S+@\S+", text).span()
    assert rows[1].spans == f"email:{mail[0]}:{mail[1]},term:{at}:{at + 8}"
    assert (rows[1].n_term, rows[1].n_removed, rows[1].n_generalised) == (1, 1, 0)
    left = text[: mail[0]] + "[EMAIL]" + text[mail[1] : at] + text[at + 8 :]
    assert rows[1].sanitised_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert all(rows[10 + k].spans == "" for k in range(40))


def test_disclosure_against_brute_force(spark):
    """Every pair's share, from sets of texts."""
    rng = random.Random(3)
    values = ["ann.lee@a.example.org", "bo42.kim@b.example.org", "10.1.2.3", "+44 20 7946 0958", "the.x@c.example.org"]
    texts = []
    for k in range(60):
        words = prose(k, 25).split()
        for value in rng.sample(values, rng.randrange(3)):
            words.insert(rng.randrange(len(words)), f"{rng.choice(['tell7', 'kim', 'LEE', 'quux'])} {value} {rng.choice(['tell7', 'quux', 'é'])}")
        texts.append(" ".join(words))
    texts += texts[:20]
    docs = plain(spark, [(k, t, "en", "a") for k, t in enumerate(texts)])
    term = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
    distinct = sorted(set(texts))
    holds, of_entity, near = {}, {}, {}
    for n, text in enumerate(distinct):
        found = [(m.start(), m.end(), lower(m[0])) for m in term.finditer(text)]
        for _, _, w in found:
            holds.setdefault(w, set()).add(n)
        around = {}
        for kind, a, b in brute(text):
            value = (kind, text[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[a:b]))
            of_entity.setdefault(value, set()).add(n)
            before = [w for x, y, w in found if y <= a][-pii.NEAR :]
            after = [w for x, y, w in found if x >= b][: pii.NEAR]
            around.setdefault(value, set()).update(before + after)
            if kind == "email":
                for x, y, w in found:
                    if a <= x < a + text[a:b].index("@") and len(w) >= 3 and not w.isdigit():
                        near.setdefault((value, w, None), set()).add(n)
        for value, words in around.items():
            for w in words:
                near.setdefault((value, w, frozenset(words)), set()).add(n)
    shares = {}
    for value, w in {(v, w) for v, w, _ in near}:
        own = [t for (v, x, c), t in near.items() if (v, x) == (value, w) and c is not None]
        named = near.get((value, w, None), set())
        for hits, enough in ((set().union(*own), len(own) >= 2), (named, bool(named))):
            if enough:
                information = math.log(len(distinct) / len(of_entity[value]))
                share = 1 + math.log(len(hits) / len(holds[w])) / information
                shares[w] = max(share, shares.get(w, -9))
    want = {pii.term_hashes([w])[0]: s for w, s in shares.items() if s >= 0.3}
    made = {r.term: r.disclosure for r in pii.revealing_terms(docs, least=2, generalise=0.3).collect()}
    assert made.keys() == want.keys() and len(made) > 3
    assert all(made[t] == pytest.approx(s) for t, s in want.items())


def test_many_values_in_one_text_take_linear_time(spark):
    text = " ".join(f"w{k} user{k}@host.example.com" for k in range(20_000))
    docs = plain(spark, [(1, text, "en", "a"), (2, "w5 and user7", "en", "a")])
    began = time.monotonic()
    rows = {r.doc_id: r for r in pii.scan(docs).collect()}
    assert rows[1].n_email == 20_000 and time.monotonic() - began < 40


def test_passes_give_the_same(spark):
    docs = plain(spark, secretive())
    terms = pii.revealing_terms(docs, least=1, generalise=0.1)
    assert terms.count() > 5
    one = sorted(map(tuple, pii.digest(pii.find_personal(docs, terms)).collect()))
    many = sorted(map(tuple, pii.digest(pii.find_personal(docs, terms, most=2)).collect()))
    assert one == many


def test_sanitise(spark):
    rows = [(1, "zebra37 says: boss@corp.example.com 1.2.3.4 +44 20 7946 0958", "en", "a"), (2, None, "en", "a")]
    docs = plain(spark, rows)
    for share, want in ((0.97, "[TERM]"), (1.0, "")):
        [term] = pii.term_hashes(["zebra37"])
        terms = spark.createDataFrame([(term, share)], "term long, disclosure double")
        made = pii.sanitise(pii.find_personal(docs, terms))
        assert made.columns == docs.columns
        assert {(r.doc_id, r.text) for r in made.collect()} == {(1, f"{want} says: [EMAIL] [IP] [PHONE]"), (2, None)}


def test_empty(spark):
    assert pii.scan(frame(spark, [])).collect() == []
