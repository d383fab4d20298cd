import random
import re

from panelgrain.llm import licenses as L


def words(text):
    return [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())]


def base_places(own):
    places = [(i, label) for label, phrase in L.BASE for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
    return sorted(places)


def test_base_places_by_definition(spark, documents, clashing):
    r = random.Random(3)
    bits = ["under the MIT license", "Apache License, Version 2.0", "CC BY-NC", "cc by", "nc", "under the", "mit", "License", "é", "a1", "\n", "K"]
    rows = [(i, " ".join(r.choice(bits) for _ in range(r.randint(0, 40)))) for i in range(80)]
    rows += [(200, None), (201, ""), (None, "cc by nc"), (202, "cc by nc"), (202, "cc by nc"), (203, "cc-by-nc " * 5000), (204, "x")]
    got = L.scan(documents(rows, clashing)).collect()
    assert len(got) == len(rows)
    want = []
    for doc, text in rows:
        places = base_places(words(text))
        labels = ",".join(sorted({label for _, label in places}))
        want.append((doc, len(words(text)), len(places), places[0][0] if places else None, places[-1][0] if places else None, labels))
    assert sorted((tuple(g)[:6] for g in got), key=str) == sorted(want, key=str)
    for g in got:
        assert 0 <= g.score <= 1 and set(filter(None, g.base_labels.split(","))) <= set(filter(None, g.labels.split(",")))
        assert (g.score == 1.0) if g.n_base else True


def test_changed_templates_are_found(spark, documents):
    text = "Permission is hereby granted, free of cost, to any person obtaining one copy of this software and all associated documentation files"
    rows = [(1, f"intro words {text} and more"), (2, "permission is granted to any person"), (3, "licensed under the GNU General Public License, version 3")]
    got = {r.doc_id: (r.labels, r.n_base) for r in L.scan(documents(rows)).collect()}
    # Three of 19 words changed leave 9 of 17 k-grams.
    assert got == {1: ("", 0), 2: ("", 0), 3: ("gpl-3", 0)}
    near = "permission is hereby granted free of charge to every person obtaining a copy of this software and associated documentation files"
    assert [r.labels for r in L.scan(documents([(1, near)])).collect()] == ["mit"]


def test_spans_are_verified(spark, documents):
    """A part said twice or words in another order do not add up to a template; added words do no harm."""
    body = L.MORE[0][1].split()
    third = len(body) // 3
    rows = [
        (1, "the gnu general public license gnu general public license"),
        (2, " ".join([*body[2 * third :], *body[third : 2 * third], *body[:third]])),
        (3, " ".join([*body[:9], "or", "so", *body[9:]])),
        (4, " ".join(body[:8]) + " " + " ".join(body[:8]) + " " + " ".join(body[:8])),
        (5, " ".join(body) + " " + " ".join(body)),
        (6, "so " * 30000 + " ".join(body)),
    ]
    got = {r.doc_id: r for r in L.scan(documents(rows)).collect()}
    assert {d: r.labels for d, r in got.items()} == {1: "", 2: "", 3: "mit", 4: "", 5: "mit", 6: "mit"}
    assert got[5].score == 1.0 and 0.8 < got[3].score < 1.0 and got[1].score == 0.0


def test_sql_says_the_same(spark, documents):
    import duckdb

    r = random.Random(5)
    say = lambda t: " ".join(w for w in t.split() if r.random() > 0.06) + (" and" if r.random() < 0.3 else "")
    texts = [" ".join(say(t) for _, t in r.choices(L.MORE + L.BASE, k=r.randint(0, 5))) for _ in range(150)]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = db.execute(L._sql()).fetchall()
    assert sorted(tuple(g) for g in L.scan(documents(list(enumerate(texts)))).collect()) == sorted(want)
    assert len({w[6] for w in want}) > 5


def test_empty_table(spark, documents):
    assert L.scan(documents([(1, "x")]).limit(0)).collect() == []
