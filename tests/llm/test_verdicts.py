"""Scans whose model decides: planted secrets and personal data outside the fixed patterns, and verdicts on what the patterns found."""

import random
import string

import numpy as np

from loamgrid.llm import pii, registry, secrets

SF = "/root/testdata/sf0.01"


def planted(spark, values, seed):
    """A document of the test table per value, with the value set between two of its words; ``id: (text, start, end)``."""
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text", "doc_id").orderBy("doc_id").collect() if r.text and len(r.text) > 200]
    r, out = random.Random(seed), {}
    for i, v in enumerate(values):
        t = texts[(i * 7 + seed) % len(texts)][:3000]
        at = r.choice([k for k, c in enumerate(t) if c == " "])
        out[i] = (f"{t[:at]} {v} {t[at + 1 :]}", at + 1, at + 1 + len(v))
    return out


def hits(found, docs):
    """Share of planted values that a span meets."""
    return np.mean([any(s < e2 and e > s2 for s, e in found.get(i, [])) for i, (_, s2, e2) in docs.items()])


def test_planted_secrets_are_found_and_names_are_not(spark):
    r = random.Random(11)
    draw = lambda a, n: next(x for x in iter(lambda: "".join(r.choices(a, k=n)), None) if secrets.MIXED.match(x))
    full = string.ascii_letters + string.digits
    loose = [draw(a, n) for n in (12, 16, 24, 40) for a in (full, full + "+/", string.ascii_lowercase + string.digits, string.ascii_uppercase + "234567") for _ in range(15)]
    locked = [f"{w}{draw(full, 9)}" for w in ("pwd: ", "auth=", "Bearer ", "postgres://root:", "passphrase is ", "signing_key = '") for _ in range(15)]
    names = [f"{a}_{b}{n}" for a, b, n in zip(r.choices(["checksum", "customer", "holiday", "release", "weather", "station"], k=200), r.choices(["table", "report", "number", "overview", "results"], k=200), range(200))]
    docs = {k: planted(spark, v, 3) for k, v in (("loose", loose), ("locked", locked), ("names", names))}
    rows = [(k, i, t) for k, d in docs.items() for i, (t, _, _) in d.items()]
    df = spark.createDataFrame([(n, t) for n, (_, _, t) in enumerate(rows)], "doc_id long, text string")
    found = {k: {} for k in docs}
    added = 0
    for x in secrets.find_secrets(df).collect():
        k, i, _ = rows[x.doc_id]
        own = [(s.start, s.end) for s in x.found if s.kind == "model"]
        found[k][i] = own
        added += len(own)
    recall = {k: hits(found[k], docs[k]) for k in docs}
    assert recall["loose"] > 0.9 and recall["locked"] > 0.85 and recall["names"] < 0.03
    true = sum(recall[k] * len(docs[k]) for k in ("loose", "locked"))
    assert true / added > 0.95
    # a model that says the same of every token finds all names or no secret
    for flat in (2.0, -2.0):
        same = [bool(secrets.model_spans(t, secrets.base_spans(t), np.full(128 * 128, flat))) for t, _, _ in docs["names"].values()], [bool(secrets.model_spans(t, secrets.base_spans(t), np.full(128 * 128, flat))) for t, _, _ in docs["loose"].values()]
        assert all(same[0]) and all(same[1]) or not any(same[0]) and not any(same[1])


def test_verdicts_on_base_secrets_differ(spark):
    """Hex tokens are likely, runs of digits that the hex pattern takes are not."""
    out = registry.queries()["op3_secret_scan"](spark, SF).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = {True: [], False: []}
    for r in out:
        spans = [text[r.doc_id][int(a) : int(b)] for _, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        if spans:
            seen[all(s.isdigit() for s in spans)].append(r.n_likely)
        else:
            assert r.n_likely == 0 and r.top_ratio is None
    assert np.mean([n == 0 for n in seen[True]]) > 0.95 and np.mean([n > 0 for n in seen[False]]) > 0.95


def test_planted_personal_data_is_found(spark):
    r = random.Random(12)
    first, last = ["Maria", "James", "Ahmed", "Sophie", "Carlos", "Anna", "David", "Laura"], ["Whitfield", "Okonkwo", "Lindqvist", "Moreau", "Castellano", "Brandt", "Novak", "Tanaka"]
    plants = {
        "name": [f"{w} {r.choice(first)} {r.choice(last)}" for w in ("My name is", "Dear", "Contact:", "patient", "Signed by", "Mrs.", "Dr.") for _ in range(12)],
        "street": [f"{w} {r.randrange(1, 400)} {r.choice(['Oak', 'Maple', 'Church', 'Station'])} {r.choice(['Street', 'Avenue', 'Road', 'Lane'])}" for w in ("lives at", "address:", "ship to") for _ in range(20)],
        "birth": [f"{w} {r.randrange(1, 29):02d}{s}{r.randrange(1, 13):02d}{s}{r.randrange(1935, 2009)}" for w in ("born on", "date of birth:", "DOB") for s in "/.-" for _ in range(8)],
        "account": [f"{w} {r.randrange(10**7, 10**10)}" for w in ("account number:", "acct", "passport no.", "customer id", "Kontonummer") for _ in range(12)],
        "ssn": [f"SSN {r.randrange(100, 600)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}" for _ in range(30)],
        "nothing": [f"{w} {v}" for w, v in (("chapter", "12/03/2001"), ("section", "400 Oak trees"), ("version", "12345678"), ("figure", "3.14.1592"), ("page", "100 Main points"), ("total", "98765432")) for _ in range(15)],
    }
    docs = {k: planted(spark, v, 5) for k, v in plants.items()}
    rows = [(k, i, t) for k, d in docs.items() for i, (t, _, _) in d.items()]
    df = spark.createDataFrame([(n, t) for n, (_, _, t) in enumerate(rows)], "doc_id long, text string")
    found, clean = {k: {} for k in docs}, 0
    for x in pii.find_personal_data(df).collect():
        k, i, _ = rows[x.doc_id]
        spans = [s.split(":") for s in x.spans.split(",") if s]
        found[k][i] = [(int(a), int(b)) for kind, a, b in spans if kind in pii.LOOSE_KINDS]
    recall = {k: hits(found[k], docs[k]) for k in docs}
    assert min(recall[k] for k in ("name", "street", "birth", "account", "ssn")) > 0.8, recall
    assert recall["nothing"] < 0.1, recall


def test_verdicts_on_base_personal_data_differ(spark):
    """The posterior of a document follows what its spans are: private addresses and round numbers weigh less than mail and cards."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    df = spark.createDataFrame(
        [(1, "contact me by email at anna.brandt@example.org please"), (2, "version 10.0.0.1 of the server"), (3, "none here"), (4, "card 4111 1111 1111 1111, call +1 (555) 123-4567"), (5, None)], "doc_id long, text string"
    ).unionByName(docs.select((docs.doc_id + 100).alias("doc_id"), "text"))
    got = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert got[1].risk > 0.99 and got[4].risk > 0.99 and got[2].risk < got[1].risk - 0.01 and got[3].risk == got[5].risk == 0.0
    assert got[1].n_likely == 1 and got[4].n_likely == 2
    assert len({r.n_likely for r in got.values()}) > 2
