"""Disclosing terms: copies change no count, and a flagged term is marked wherever it stands."""

from math import log2

from millrace.llm import pii

FAR = " ".join(f"apart{k}" for k in range(12))


def corpus(spark, copies):
    rows = [f"word{i} filler{i} Zorblax wrote to bob@site.org about other{i}" for i in range(3)] * copies
    rows += [f"plain text number{i} wrote about" for i in range(400)]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_copies_lower_no_disclosure(spark):
    once, often = ({r["term"]: (r["action"], round(r["disclosed"], 9)) for r in pii.disclosing(corpus(spark, n)).collect()} for n in (1, 40))
    assert once == often and once["zorblax"] == ("remove", 1.0)


def test_a_flagged_term_is_marked_in_the_whole_of_every_text(spark):
    rows = [f"word{i} filler{i} Zorblax wrote to bob@site.org about {FAR} again Zorblax, ended{i}" for i in range(4)]
    rows += [f"{FAR} nothing here but Zorblax", "Zorblaxian is another word"] + [f"plain text number{i} wrote about" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert not any("Zorblax" in clean[i].split() or "Zorblax," in clean[i] for i in range(5))
    assert clean[5] == rows[5] and all(clean[i] == rows[i] for i in range(6, len(rows)))


def test_terms_far_from_the_entity_count(spark):
    rows = [f"word{i} to bob@site.org about {FAR} at Quuxly, ended{i}" for i in range(4)] + [f"plain text number{i} about" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r["term"] for r in pii.disclosing(docs).collect()} >= {"quuxly"}


def by_definition(texts, threshold, left):
    """{(entity, term): (action, disclosed)} over sets of whole texts."""
    n, terms, held, df = len(texts), {t: pii.terms_of(t) for t in texts}, {}, {}
    for t in texts:
        for e, around in pii.contexts(t).items():
            held.setdefault(e, {})[t] = around
        for term in terms[t]:
            df[term] = df.get(term, 0) + 1
    held = {e: by for e, by in held.items() if len(set(by.values())) >= pii.SUPPORT}
    out = {}
    for e, by in held.items():
        shared = {}
        for t in by:
            for term in terms[t]:
                shared.setdefault(term, []).append(t)
        told = lambda term, d: log2(len(shared[term]) * n / (d * len(by))) / log2(n / len(by))  # noqa: B023, E731
        over = lambda term, d: told(term, d) >= threshold and (left is None or log2(d / len(shared[term])) <= left)  # noqa: B023, E731
        for term, among_texts in shared.items():
            if not term.endswith("*") and len({by[t] for t in among_texts}) >= pii.SUPPORT and over(term, df[term]):
                stem = pii.stem_of(term)
                out[e, term] = ("remove" if over(stem, df[stem]) else "generalise", round(told(term, df[term]), 9))
    return out


def test_both_actions_on_the_driver_table_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r[0] or "" for r in docs.select("text").collect()}
    actions = set()
    for threshold, left in ((pii.THRESHOLD, None), (0.5, None), (0.6, 1.0)):
        got = pii.disclosing(docs, threshold=threshold, left=left).collect()
        got = {(r["entity"], r["term"]): (r["action"], round(r["disclosed"], 9)) for r in got}
        assert got == by_definition(texts, threshold, left) and got
        actions |= {a for a, _ in got.values()}
    assert actions == {"remove", "generalise"}


def test_a_family_is_protected_where_no_address_repeats(spark):
    rows = [f"word{i} filler{i} Zorblax wrote to person{i}@site{'.a' * (i % 2)}.org about other{i}" for i in range(8)] + [f"plain text number{i} wrote about" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {(r["entity"], r["term"]) for r in pii.disclosing(docs).collect()}
    assert ("any email", "zorblax") in got and not any(e.startswith("email:") for e, _ in got)


def test_a_directory_printed_often_is_one_group(spark):
    page = " ".join(f"person{k}@site.org" for k in range(300))
    rows = [f"Quuxly issue{i} {page} printed{i} for{i}" for i in range(4)] + [f"plain text number{i} for" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got, members = pii.disclosed_groups(docs, "text", 1, pii.THRESHOLD, pii.LEFT)
    found = {r["group"] for r in got.filter("term = 'quuxly'").collect()}
    assert len(found) < 10 and members.join(got.select("group").distinct(), "group").count() >= 300
    assert pii.disclosing(docs, support=1).filter("term = 'quuxly'").count() >= 300
