"""Whole queries against brute force over the same tables, column by column."""

import hashlib
import re
import unicodedata

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import bpe, digest, pii, queries, sharding, simhash, url_filter

SF = "/root/testdata/sf0.001"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op1_host_path_and_rule(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op1_url_filter(spark, SF).collect()
    assert len(got) == len(urls)
    for r in got:
        rest = (urls[r["page_id"]] or "").partition("://")
        host = re.split(r"[/?#]", rest[2])[0] if rest[1] else ""
        path = re.split(r"[?#]", rest[2][len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(x), v, x) for v, x in url_filter.RULES if (host == x.split("/")[0] or host.endswith("." + x.split("/")[0])) and path.startswith(x[x.index("/") :])]
        best = max(fits, default=(0, None, None))
        assert (r["host"], r["path"], r["rule"]) == (host, path, best[2])
        assert r["verdict"] == (best[1] or ("block" if r["score"] > 0.5 else "allow"))


EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(CARD, text) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_op5_columns(spark):
    docs = texts(spark)
    got = queries.op5_pii(spark, SF).collect()
    assert len(got) == len(docs) and sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in got) > 0
    for r in got:
        want = spans(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in want) for k in pii.KINDS]
        assert r["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in want))
        assert [s for s in r["spans"].split(",") if s and s.split(":")[0] in pii.KINDS] == [f"{k}:{a}:{b}" for k, a, b in want]


def test_disclosed_terms_by_brute_force(spark):
    """Every term of the planted texts and of the driver's table, over sets of whole texts."""
    from math import log2

    rows = [f"word{i} filler{i} Zorblax wrote to bob@site.org about other{i} Common{i % 2}" for i in range(5)] * 3 + ["Zorblax alone in another text"] + list(texts(spark).values())
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    different = set(rows)
    terms = {t: {x for x in pii.terms_of(t) if not x.endswith("*")} for t in different}
    held = {}
    for t in different:
        for e, around in pii.contexts(t).items():
            held.setdefault(e, {})[t] = around
    want = {}
    for e, by in held.items():
        if len(set(by.values())) < pii.SUPPORT:
            continue
        for term in set().union(*[terms[t] for t in by]):
            shared = [t for t in by if term in terms[t]]
            if len({by[t] for t in shared}) < pii.SUPPORT:
                continue
            df = sum(term in x for x in terms.values())
            told = log2(len(shared) * len(different) / (df * len(by))) / log2(len(different) / len(by))
            if told >= pii.THRESHOLD and log2(df / len(shared)) <= pii.LEFT:
                want[e, term] = round(told, 9)
    assert {(r["entity"], r["term"]): round(r["disclosed"], 9) for r in pii.disclosing(docs).collect()} == want and want


def test_op8_is_the_library(spark):
    path = str(P.path("byte_bpe_multi_50k.tiktoken"))
    lib, docs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={}), texts(spark)
    for r in queries.op8_bpe(spark, SF).collect():
        ids = lib.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(docs[r["doc_id"]]))
    coder = bpe.codec(path, P.PATTERN)
    raw = coder.transducer.ranks[b"\xff"]
    assert coder.decode([raw]) == "�" and [t for _, t in coder.decode_stream([raw])] == ["\udcff"]


def form(text):
    return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold()).split())


def test_op10_columns(spark):
    docs = texts(spark)
    order, got = sorted(docs, reverse=True), {r["doc_id"]: r for r in queries.op10_digest(spark, SF).collect()}
    sizes, first = {}, {}
    for i in sorted(docs):
        f = form(docs[i])
        sizes[f] = sizes.get(f, 0) + 1
        first.setdefault(f, i)
    assert got.keys() == docs.keys()
    for at, i in enumerate(order):
        text, after = docs[i], docs[order[(at + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(edited))
        assert (r["near_edited"], r["near_next"]) == (float(form(edited) == form(text)), float(form(after) == form(text)))
        assert (r["group_id"], r["group_size"]) == (first[form(text)], sizes[form(text)])


def test_a_collision_joins_no_texts(spark, monkeypatch):
    """All texts under one fingerprint: the bytes still tell them apart, in parts of two rows."""
    monkeypatch.setattr(digest, "fingerprint_of", lambda value: F.concat(F.lit("same"), F.substring(value, 1, 0)))
    monkeypatch.setattr(digest, "PART_ROWS", 2)
    rows = [(i, ["one", "ONE ", "two", "three"][i % 4]) for i in range(16)]
    got = digest.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {i: {0: (0, 8), 1: (0, 8), 2: (2, 4), 3: (3, 4)}[i % 4] for i, _ in rows}
    assert {r["doc_id"]: (r["group_id"], r["group_size"]) for r in got} == want


def test_an_independent_fill():
    """Each shard's whole order is written out; turns are taken by removing taken slots from the orders."""
    names, slots = [f"s{i}" for i in range(5)], 101
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    orders = [[(number(f"offset:{s}") % slots + k * (number(f"step:{s}") % (slots - 1) + 1)) % slots for k in range(slots)] for s in names]
    assert all(sorted(o) == list(range(slots)) for o in orders)
    table = {}
    while len(table) < slots:
        for i, order in enumerate(orders):
            free = [x for x in order if x not in table]
            if free:
                table[free[0]] = i
    assert sharding.fill(names, slots) == [table[k] for k in range(slots)]


def test_rows_of_one_id_and_other_text_stay(spark):
    far = [" ".join(f"{w}{k}" for k in range(40)) for w in ("a", "b", "c")]
    docs = spark.createDataFrame([(5, far[0]), (5, far[1]), (7, far[2]), (7, far[2]), (9, far[2]), (None, far[0])], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect())
    assert got == sorted([(5, far[0]), (5, far[1]), (7, far[2])])
