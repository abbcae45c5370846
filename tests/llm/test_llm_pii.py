import hashlib
import math
import random
import re
from collections import defaultdict
from itertools import count

import pytest
from pyspark.sql import functions as F

from tallyshelf.llm.pii import BASE, find_pii, mask_pii, pattern_scores, span_list

#: The base patterns as the contract words them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def counts(kind, hit):
    number = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 13 <= len(number) <= 19 and luhn(number)
    return kind != "phone" or 9 <= len(number) <= 15


def brute(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "", re.ASCII)
        if counts(kind, m.group())
    ]


TEXTS = [
    None,
    "",
    "mail a.b+c@x-y.example.com, or x@y, a@b@c.d, foo_bar@x.y_z@q.r.s.",
    "a@b.c_d@e.f a@b.c.@d.e ...@-.-",
    "ips 1.2.3.4 256.1.1.1 001.002.003.255 1.2.3.4.5.6.7.8 1.2.3 0000255.1.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 1 2 3, 12  34 5- 6",
    "call +1 (369) 555-1339 or +49 30 1234 or +1-2-3-4-5-6-7-8-9. +12345678901234567 +1( +",
    "🙂日本 1.2.3.4 é a@b.cd \n+1 (369) 555-1339\n" * 3,
    "9" * 3000 + " " + "1 " * 2000,
    "a" * 20000 + " " + "x.y." * 5000 + "@",
]


def find(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    out = find_pii(frame, "text", ["doc_id"]).select("doc_id", "id", span_list(BASE).alias("base"))
    return {r.doc_id: r for r in out.collect()}


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(1)
    alphabet = list("0123456789" * 3 + "..--@@+() ab_%🙂é,\n") + ["1.2.3.4", "4111111111111111", "@x.y"]
    texts = [*TEXTS, *("".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(400))]
    out = find(spark, texts)
    assert {i: r.base for i, r in out.items()} == {i: ",".join(brute(t)) for i, t in enumerate(texts)}


def test_empty_table_gives_an_empty_table(spark):
    assert find(spark, []) == {}


def test_contexts_discover_unseen_identifiers(spark):
    seen = [f"note {i} customer account 10.0.{i}.7 closed" for i in range(12)]
    unseen = ["the customer account QX-7731-55 closed", "the customer account none closed"]
    other = [f"version number QX-{i:04d}-77 of it" for i in range(20)]
    texts = [*seen, *unseen, *other]
    out = find(spark, texts)
    span = out[12].id[0]
    assert [(s.start, s.end) for s in out[12].id] == [(21, 31)]
    assert texts[12][span.start : span.end] == "QX-7731-55"
    assert all(not out[i].id for i in range(len(texts)) if i != 12)


def test_long_hexadecimal_secrets_are_found(spark):
    secret = hashlib.sha1(b"x").hexdigest()
    out = find(spark, [f'token = "{secret}" end', "plain text"])
    assert [(s.start, s.end) for s in out[0].id] == [(9, 49)]
    assert out[1].id == []


def test_scores_spread_from_seeds(spark):
    edges = [("p", f"s{i}", True) for i in range(9)] + [("p", "x", False), ("q", "x", False), ("q", "y", False)]
    out = {r.pattern: r for r in pattern_scores(spark.createDataFrame(edges, "pattern string, run string, seed boolean")).collect()}
    assert out["p"].support == 9 and out["p"].confidence > 0.85
    assert out["q"].support == 0 and 0.2 < out["q"].confidence < 0.6


@pytest.mark.parametrize("name", ["text", "_row", "id", "email"])
def test_masked_texts_and_other_columns(spark, name):
    rows = [(1, "mail a@b.cd now", "k"), (1, None, "k"), (None, "nothing", None), (2, "🙂 1.2.3.4 + 4111111111111111", "x")]
    frame = spark.createDataFrame(rows, f"candidates int, `{name}` string, spans string")
    out = mask_pii(frame, name)
    assert out.columns == ["candidates", name, "spans"]
    assert sorted(out.collect(), key=str) == sorted(
        [(1, "mail <EMAIL> now", "k"), (1, None, "k"), (None, "nothing", None), (2, "🙂 <IP> + <CARD>", "x")], key=str
    )


def test_overlapping_spans_are_masked_once(spark):
    frame = spark.createDataFrame([("write to a@1.2.3.4 or 1.2.3.4",)], "text string")
    assert mask_pii(frame, "text").first().text == "write to <EMAIL> or <IP>"


def test_no_digit_of_a_span_is_left(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS[2:7]], "text string")
    masked = mask_pii(frame, "text").filter(F.col("text").rlike(r"[0-9]{1,3}(\.[0-9]{1,3}){3}"))
    assert all("256.1.1.1" in r.text for r in masked.collect())


def test_found_identifiers_support_further_patterns(spark):
    """Seeds to a pattern, to identifiers, to a second pattern without any seed, to a new identifier."""
    seeds = [f"the customer account 10.0.{i}.7 closed" for i in range(40)]
    first = [f"the customer account QX-77{i:02d}-55 closed" for i in range(20)]
    second = [f"paid by member QX-77{i:02d}-55 today" for i in range(20)]
    texts = [*seeds, *first, *second, "paid by member ZK-9041-18 today", "paid in version ZK-9041-19 today"]
    out = find(spark, texts)
    assert [[s.hit for s in out[i].id] for i in (40, 60, 80, 81)] == [["qx-7700-55"], ["qx-7700-55"], ["zk-9041-18"], []]


#: Runs, context tokens and secrets as the module words them.
RUN = r"(?<![A-Za-z0-9._@/+-])[A-Za-z._@/+-]*+[0-9][A-Za-z0-9._@/+-]*+"
TOKENS = r"[^\x20\x09-\x0D\x22'`,;!?]+|[,;!?]"
SECRET = r"(?=.*[0-9])(?=.*[a-f])[0-9a-f]{32,128}"


def candidate_runs(text):
    """``(start, end, run, patterns, base, secret)`` of each candidate, contexts from the whole text's token sequence."""
    matches = list(re.finditer(RUN, text))
    base = [tuple(map(int, s.split(":")[1:])) for s in brute(text)]
    sequence, places, at = ["^", "^"], [], 0
    for m in matches:
        sequence += re.findall(TOKENS, re.sub("[0-9]+", "0", text[at : m.start()].lower()))
        places.append(len(sequence))
        sequence.append("0")
        at = m.end()
    sequence += [*re.findall(TOKENS, re.sub("[0-9]+", "0", text[at:].lower())), "$", "$"]

    def wordy(*tokens):
        return re.search("[a-z]", "".join(tokens))

    for m, j in zip(matches, places, strict=True):
        run = m.group().lower()
        second, last, ahead, then = (sequence[j + k] for k in (-2, -1, 1, 2))
        two = f"2:{second} {last}" + ("" if wordy(second, last) else f" _ {ahead}")
        patterns = (two, f"b:{last} _ {ahead}" + ("" if wordy(last, ahead) else f" {then}"))
        is_base = any(a < m.end() and b > m.start() for a, b in base)
        secret = re.fullmatch(SECRET, run) is not None
        if is_base or secret or len(run) >= 6 and len(re.sub("[^0-9]", "", run)) >= 3:
            yield m.start(), m.end(), run, patterns, is_base, secret


def bootstrapped(texts):
    """The found spans, by plain loops over the graph."""
    runs = [(i, *c) for i, t in enumerate(texts) for c in candidate_runs(t or "")]
    seed = defaultdict(bool)
    for _, _, _, run, patterns, base, secret in runs:
        for p in patterns:
            seed[p, run] |= base or secret
    score = {e: float(s) for e, s in seed.items()}
    reached = dict.fromkeys(seed, False)
    before = None
    for done in count(1):
        members = defaultdict(list)
        for p, run in seed:
            members[p].append(run)
        confidence = {p: sum(score[p, r] for r in rs) / (len(rs) + 1) for p, rs in members.items()}
        sure = {
            p
            for p, rs in members.items()
            if confidence[p] >= 0.8 and sum(seed[p, r] or reached[p, r] for r in rs) >= 5
        }
        if done >= 3 and len(sure) == before:
            break
        before = len(sure)
        by_run = defaultdict(list)
        for p, run in seed:
            by_run[run].append(p)
        for run, ps in by_run.items():
            chance = 1 - math.prod(1 - confidence[p] for p in ps if confidence[p] >= 0.5)
            for p in ps:
                score[p, run] = 1.0 if seed[p, run] else chance
                reached[p, run] = any(q in sure for q in ps)
    out = [set() for _ in texts]
    for i, start, end, _, patterns, base, secret in runs:
        if not base and (secret or sure & set(patterns)):
            out[i].add((start, end))
    return [sorted(o) for o in out]


def lines(rng):
    words = ["account", "customer", "of", "the", "row", "paid", "by", "member", "see", "total"]
    number = lambda: f"{rng.choice(['QX', 'ACC', 'M'])}-{rng.randint(1000, 9999)}{rng.choice(['', '-77'])}"
    things = [lambda: f"10.0.{rng.randint(0, 255)}.7", number, lambda: str(rng.randint(1, 10**6)), lambda: f"a{rng.randint(0, 99)}@b.cd"]
    shapes = ["{w} {w} {t} {w}", "{n},{t},2020-01-01 {w}", "{t}", "{w}: {t}, {t}; {w} {t}", "{w} {w} {w}", "{w} {t} {t} {t}"]
    shape = rng.choice(shapes)
    while (m := re.search(r"\{([wtn])\}", shape)) is not None:
        made = {"w": lambda: rng.choice(words), "t": lambda: rng.choice(things)(), "n": lambda: str(rng.randint(1, 5000))}[m[1]]()
        shape = shape[: m.start()] + made + shape[m.end() :]
    return shape


@pytest.mark.parametrize("seed", [1, 2])
def test_found_spans_equal_a_plain_bootstrap(spark, seed):
    rng = random.Random(seed)
    secret = hashlib.sha1(b"y").hexdigest()
    texts = [lines(rng) for _ in range(250)] + [None, "", f"key {secret},1", f"{secret}", "1 2 3456789 4", "ends 12-3456"]
    texts += [f"customer account 10.0.{i}.9 closed" for i in range(30)] + ["customer account ZZ-10001 closed"] * 3
    out = find(spark, texts)
    want = bootstrapped(texts)
    assert [sorted((s.start, s.end) for s in out[i].id) for i in range(len(texts))] == want
    assert any(want) and want[-1]


def test_identifiers_between_numbers_and_at_the_edges(spark):
    """Contexts of lines of a table, and of identifiers that begin or end a text or are all of it."""
    texts = [f"row 1001,a{i}@y.org,2020-01-01 end" for i in range(10)] + [f"row 1001,ACC-7771{i},2020-01-01 end" for i in range(5)]
    texts += [f"10.0.{i}.1 logged in" for i in range(12)] + ["HOST-20017 logged in"]
    texts += [f"reply to b{i}@z.net" for i in range(12)] + ["reply to ID-4711-0815"]
    out = find(spark, texts)
    hits = [[texts[i][s.start : s.end] for s in out[i].id] for i in range(len(texts))]
    assert hits[10:15] == [[f"ACC-7771{i}"] for i in range(5)]
    assert hits[27] == ["HOST-20017"] and hits[40] == ["ID-4711-0815"]
    assert not any(hits[i] for i in [*range(10), *range(15, 27), *range(28, 40)])


def test_kept_columns_must_not_be_called_like_the_spans(spark):
    frame = spark.createDataFrame([("a@b.cd", 1, 2)], "text string, id int, plain int")
    with pytest.raises(ValueError):
        find_pii(frame, "text", ["id"])
    assert find_pii(frame, "text", ["plain"]).first().plain == 2
