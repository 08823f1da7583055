"""Personal data: pattern spans, and information-theoretic sanitisation of the terms around them.

Every match of a base pattern is a protected entity (its kind and value), and so are the classes it belongs to: its family (the
domain of an address, the network, the issuer or area of a number) and its kind. All counts are of different texts, so copies of a
text change none of them: a term t (a whole word of the text that touches no base span) and an entity e that share c of N
texts, t in df(t) and e in df(e) of them, have pointwise mutual information log2(c N / (df(t) df(e))); over the information
of e, log2(N / df(e)), that is how much of e the term gives away. The texts must hold e in at least `support` different
contexts (the `window` words around it), so near-copies of one document prove nothing. A term over the threshold that leaves
no more than half a bit, log2(df(t) / c), unknown (else it mostly stands in texts without the entity) is
sanitised wherever it stands, in every text: generalised to its first letters where those, counted like a term, pass no
threshold, removed otherwise.

Texts that hold an entity of enough contexts are counted first; a term meets an entity there only if the least and the most
texts that the two could share let it pass, so a text never yields all its entities by all its terms. The corpus is counted
map-side for the terms that passed that far, each text divided by its copies. Only terms over the threshold go back to the
texts: as a broadcast where they are checked to be few, else by a join on a digest of the text.

Defined results: a null text counts as empty and has no spans. Repeated rows get equal spans. Base spans all
stay, also where they overlap each other; a word that touches one is no term. Positions are code points.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_ROWS, bound_batches, bounded_broadcast, free_name, materialize, skew_join, text_or_empty

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")
WINDOW, SUPPORT, THRESHOLD, STEM, LEAST = 5, 3, 0.75, 4, 3
#: Digits of a card or phone number that name its family.
FAMILY = 6
#: Bits about the entity that a disclosing term leaves unknown at most (None: any): it comes with the entity in seven of ten texts or more.
LEFT = 0.5
SPANS = "array<struct<kind:string,start:int,end:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = re.compile(r"^\W+|\W+$")
#: ASCII characters that are no word characters.
_MARKS = "".join(c for c in map(chr, range(128)) if not c.isalnum() and c != "_")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ in linear time: the local part reaches back to the first allowed character."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every base match that passes, by start and kind."""
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(_DIGIT.findall(value))}"


def classes(kind: str, value: str) -> list[str]:
    """The entity, the family it belongs to (the domain, network, issuer or area), and its kind: all are protected."""
    key = entity(kind, value)
    own = key.partition(":")[2]
    family = own.partition("@")[2] if kind == "email" else ".".join(own.split(".")[:2]) if kind == "ip" else own[:FAMILY]
    return [key, f"{kind} of {family}", f"any {kind}"]


def term_of(word: str) -> str:
    """A word without marks at its ends, in lower case; empty if it is too short to be a term."""
    term = word.strip(_MARKS)
    if term and not ((term[0].isalnum() or term[0] == "_") and (term[-1].isalnum() or term[-1] == "_")):
        term = _EDGE.sub("", term)
    return term.lower() if len(term) >= LEAST else ""


def stem_of(term: str) -> str:
    return f"{term[:STEM]}*"


def free_words(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) for every word of the text that is a term and touches no span."""
    ends, furthest = [], 0
    for _, _, e in spans:
        furthest = max(furthest, e)
        ends.append(furthest)  # where the spans so far end at the latest
    out = []
    for m in _WORD.finditer(text):
        s, e = m.span()
        k = bisect_left(spans, e, key=lambda x: x[1])
        # no span that begins before the word's end reaches into it
        if (k == 0 or ends[k - 1] <= s) and (term := term_of(m[0])):
            out.append((term, s, e))
    return out


def words_among(text: str, wanted: dict[str, str]) -> set[str]:
    """The wanted terms among the words of a text, those that touch a base span included."""
    return {t for t in map(term_of, set(_WORD.findall(text))) if t in wanted}


def among(text: str, wanted: frozenset[str]) -> set[str]:
    """The wanted terms and stems among the words of a text, those that touch a base span included."""
    return {x for t in set(map(term_of, set(_WORD.findall(text)))) for x in (t, stem_of(t)) if x in wanted}


def terms_of(text: str) -> set[str]:
    """The different terms of a text and their stems."""
    terms = {t for t, _, _ in free_words(text, base_spans(text))}
    return terms | {stem_of(t) for t in terms}


def contexts(text: str, window: int = WINDOW) -> dict[str, str]:
    """entity, family or kind -> the terms around its base spans in the text."""
    spans = base_spans(text)
    if not spans:
        return {}
    free = free_words(text, spans)
    starts = [s for _, s, _ in free]
    out: dict[str, list[str]] = {}
    for kind, start, end in spans:
        at, until = bisect_left(starts, start), bisect_left(starts, end)
        near = [t for t, _, _ in free[max(0, at - window) : until + window]]
        for name in classes(kind, text[start:end]):
            out.setdefault(name, []).append(" ".join(near))
    return {e: "\n".join(sorted(set(near))) for e, near in out.items()}


def all_spans(text: str, flagged: dict[str, str] | None) -> list[tuple[str, int, int]]:
    """The base spans, and every occurrence of the terms that flagged (term -> action) names."""
    spans = base_spans(text)
    if not flagged or not words_among(text, flagged):
        return spans
    more = [(flagged[t], s, e) for t, s, e in free_words(text, spans) if t in flagged]
    order = (*KINDS, *TERM_KINDS)
    return sorted([*spans, *more], key=lambda x: (x[1], order.index(x[0]), x[2]))


def disclosing(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD, left: float | None = LEFT) -> DataFrame:
    """(entity, term, action, disclosed) for the terms that give away too much of an entity or class, over the whole corpus."""
    got, members = disclosed_groups(docs, text_col, support, threshold, left)
    if members is None:
        return got.select(F.col("group").alias("entity"), "term", "action", "disclosed")
    return got.join(members, "group").select("entity", "term", "action", "disclosed")


def disclosed_groups(docs: DataFrame, text_col: str, support: int, threshold: float, left: float | None) -> tuple[DataFrame, DataFrame | None]:
    """(group, term, action, disclosed), and (group, entity): entities of the same texts in equal contexts are one group.

    All counts of such entities are equal, so a directory of ten thousand addresses that is printed in many texts is one
    group, not ten thousand. Nothing is held where no entity has enough contexts (then there are no members).
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(text_or_empty(text_col).alias("text")).withColumn("digest", F.md5("text"))
    copies = materialize(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")))
    total = materialize(copies.agg(F.count(F.lit(1)).cast("double").alias("n")))
    copies = copies.filter("copies > 1")

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, e, around) for d, text in zip(batch["digest"], batch["text"], strict=True) for e, around in contexts(text).items()]
            yield pd.DataFrame(rows, columns=["digest", "entity", "around"], dtype=object)

    met = texts.mapInPandas(held, "digest string, entity string, around string")
    met = materialize(met.select("digest", "entity", F.xxhash64("around").alias("context")).distinct())
    known = met.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("context").alias("contexts")).filter(F.col("contexts") >= support)
    known = materialize(known.select("entity", "n"))
    empty = docs.sparkSession.createDataFrame([], "group string, term string, action string, disclosed double")
    if known.isEmpty():
        return empty, None
    met = skew_join(met, known.withColumn("e", F.col("n")), "entity", met.count())
    # the sets of texts by context tell which entities have all counts alike: two hashes of 64 bits that no order changes
    sets = met.groupBy("entity", "context", "e").agg(F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("y"))
    sets = sets.groupBy("entity", "e").agg(F.bit_xor(F.xxhash64("x", "y")).alias("x"), F.bit_xor(F.xxhash64("y", "x", F.lit(1))).alias("y"))
    sets = materialize(sets.select("entity", "e", F.concat_ws(":", "x", "y").alias("alike")))
    groups = sets.groupBy("alike").agg(F.min("entity").alias("group"), F.count(F.lit(1)).alias("n"))
    members = materialize(skew_join(sets, groups, "alike", sets.count()).select("group", "entity", "e"))
    known = members.filter(F.col("group") == F.col("entity")).select("entity", "e")  # one entity stands for its group
    most = materialize(known.agg(F.max("e").alias("most")))  # one row
    per_text = met.join(bounded_broadcast(known.select("entity"), known.count()), "entity", "left_semi")
    per_text = materialize(per_text.groupBy("digest").agg(F.collect_list(F.struct("entity", "context", "e")).alias("held")))
    rows = per_text.count()
    with_held = texts.join(bounded_broadcast(per_text.select("digest"), rows), "digest", "left_semi").dropDuplicates(["digest"])

    def list_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"digest": batch["digest"], "terms": pd.Series([list(terms_of(t)) for t in batch["text"]], dtype=object, index=batch.index)})

    words = with_held.mapInPandas(list_terms, "digest string, terms array<string>").select("digest", F.explode("terms").alias("term"))
    information = F.greatest(F.log2(F.col("n") / F.col("e")), F.lit(1e-9))
    gives = lambda c, d: F.log2(F.col(c) * F.col("n") / (F.col(d) * F.col("e"))) / information
    little = lambda c, d: F.lit(True) if left is None else F.log2(F.col(d) / F.col(c)) <= left + 1e-9
    tells = lambda c, d: (gives(c, d) >= threshold - 1e-9) & little(c, d)
    # a pair shares at least `support` texts and at most e: terms of fewer texts, or of more than e lets pass, meet no entity
    seen_in = words.groupBy("term").agg(F.count(F.lit(1)).alias("least_df")).filter(F.col("least_df") >= support)
    seen_in = seen_in.crossJoin(F.broadcast(most)).crossJoin(F.broadcast(total))  # one row each
    seen_in = materialize(seen_in.withColumn("e", F.col("most")).filter(tells("e", "least_df")).select("term", "least_df"))
    if seen_in.count() <= BROADCAST_ROWS:
        met_by = words.join(F.broadcast(seen_in), "term")
    else:
        of_term = seen_in.withColumn("n", F.col("least_df"))
        met_by = skew_join(words, of_term, "term", seen_in.agg(F.sum("least_df")).first()[0])
    pairs = met_by.join(bounded_broadcast(per_text, rows), "digest").select("term", "least_df", F.inline("held")).crossJoin(F.broadcast(total))
    pairs = pairs.filter(tells("e", "least_df")).groupBy("entity", "term", "least_df", "e", "context").agg(F.count(F.lit(1)).alias("c"))
    pairs = pairs.groupBy("entity", "term", "least_df", "e").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("contexts"))
    pairs = pairs.filter(F.col("contexts") >= support).crossJoin(F.broadcast(total))
    # what a term or stem gives away falls with its df: one below the threshold at the least df cannot pass
    pairs = materialize(pairs.filter(tells("c", "least_df")).select("entity", "term", "c", "e"))
    is_stem, stems = F.col("term").endswith("*"), F.concat(F.substring("term", 1, STEM), F.lit("*"))
    open_stems = pairs.filter(is_stem).select("entity", F.col("term").alias("stem"), F.col("c").alias("stem_c"))
    strong = pairs.filter(~is_stem).withColumn("stem", stems).join(open_stems, ["entity", "stem"], "left")
    strong = materialize(strong.select("entity", "term", "c", "e", F.when(F.col("stem_c").isNotNull(), F.col("stem")).alias("stem"), "stem_c"))
    if strong.isEmpty():
        return empty, None
    wanted = materialize(strong.select(F.explode(F.array("term", "stem")).alias("term")).filter("term is not null").distinct())
    few = wanted.count() <= BROADCAST_ROWS
    listed = docs.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in wanted.toLocalIterator()) if few else None)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, float] = {}

        def counts() -> pd.DataFrame:
            out = pd.DataFrame({"term": pd.Series(list(seen), dtype=object), "texts": pd.Series(list(seen.values()), dtype=float)})
            seen.clear()
            return out

        for batch in batches:
            for text, n in zip(batch["text"], batch["copies"], strict=True):
                terms = terms_of(text) if listed.value is None else among(text, listed.value)
                if terms and base_spans(text):  # words that touch a span are no terms
                    terms &= terms_of(text)
                for t in terms:
                    seen[t] = seen.get(t, 0.0) + 1 / n
            if len(seen) > 200_000:
                yield counts()
        yield counts()

    counted = texts.join(bounded_broadcast(copies, copies.count()), "digest", "left").select("text", F.coalesce("copies", F.lit(1)).alias("copies"))
    # all copies of a text hold the term, so their parts add up to whole texts
    df = counted.mapInPandas(count, "term string, texts double").groupBy("term").agg(F.round(F.sum("texts")).cast("long").alias("df"))
    df = materialize(df.join(wanted, "term", "left_semi"))
    got = strong.join(df, "term").crossJoin(F.broadcast(total)).filter(tells("c", "df"))  # one row
    got = got.join(df.select(F.col("term").alias("stem"), F.col("df").alias("stem_df")), "stem", "left").withColumn("disclosed", gives("c", "df"))
    action = F.when(F.col("stem_c").isNotNull() & tells("stem_c", "stem_df"), "remove").otherwise("generalise").alias("action")
    return got.select(F.col("entity").alias("group"), "term", action, "disclosed"), members.select("group", "entity")


def _spans_column(text: Column, flagged: object) -> Column:
    @F.pandas_udf(SPANS)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in all_spans(t, flagged.value)] for t in batch], dtype=object)

    return of(text)


def _flagged(docs: DataFrame, text_col: str, threshold: float, left: float | None) -> tuple[DataFrame, object | None]:
    """(term, action) of the disclosing terms, and the same as a broadcast of term -> action where they are few."""
    found = disclosed_groups(docs, text_col, SUPPORT, threshold, left)[0].groupBy("term").agg(F.max("action").alias("action"))  # remove before generalise
    found = materialize(found)
    if found.count() > BROADCAST_ROWS:
        return found, None
    return found, docs.sparkSession.sparkContext.broadcast({row["term"]: row["action"] for row in found.toLocalIterator()})


def detect(docs: DataFrame, text_col: str = "text", out_col: str = "spans", threshold: float = THRESHOLD, left: float | None = LEFT) -> DataFrame:
    """docs with the array of spans (kind, start, end): base kinds, and generalise or remove for disclosing terms."""
    found, listed = _flagged(docs, text_col, threshold, left)
    return _joined_spans(docs, text_col, out_col, found) if listed is None else docs.withColumn(out_col, _spans_column(text_or_empty(text_col), listed))


def _joined_spans(docs: DataFrame, text_col: str, out_col: str, found: DataFrame) -> DataFrame:
    """docs with their spans, the flagged terms being (term, action) of a table."""
    spark, text = docs.sparkSession, text_or_empty(text_col)

    # too many to broadcast: the words meet the flagged terms in a join, the texts their spans by a digest
    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, value in zip(batch["key"], batch["text"], strict=True):
                rows = [(key, t, s, end) for t, s, end in free_words(value, base_spans(value))]
                yield pd.DataFrame(rows, columns=["key", "term", "start", "end"]).astype({"key": object, "term": object, "start": "int32", "end": "int32"})

    keyed = docs.select(F.sha2(text, 256).alias("key"), text.alias("text"))
    key, extra = free_name(docs, "_key"), free_name(docs, "_more")
    more = keyed.mapInPandas(near, "key string, term string, start int, end int").join(found, "term")
    more = more.groupBy("key").agg(F.collect_set(F.struct(F.col("action").alias("kind"), "start", "end")).alias(extra))
    out = docs.withColumn(key, F.sha2(text, 256)).join(more.withColumnRenamed("key", key), key, "left").drop(key)
    base = _spans_column(text, spark.sparkContext.broadcast(None))
    order = lambda x: F.struct(x["start"], F.array_position(F.array(*map(F.lit, (*KINDS, *TERM_KINDS))), x["kind"]).alias("o"), x["end"], x["kind"].alias("kind"))
    both = F.array_sort(F.transform(F.concat(base, F.coalesce(extra, F.array().cast(SPANS))), order))
    return out.withColumn(out_col, F.transform(both, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))).drop(extra)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def base_of(spans: Column) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*KINDS))


def redact(text: str, spans: list[dict]) -> str:
    """text with each base span as [KIND], terms cut to their first letters or taken out; of overlapping spans the first decides."""
    out, at = [], 0
    for x in sorted(spans, key=lambda x: (x["start"], -x["end"])):
        s, e, kind = x["start"], x["end"], x["kind"]
        if e <= at:
            continue
        if s < at:  # the rest of a span that another covers in part
            at = e
            continue
        out.append(text[at:s])
        if kind in KINDS:
            out.append(f"[{kind.upper()}]")
        elif kind == "generalise":
            out.append(f"{text[s:e][:STEM]}*")
        at = e
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, left: float | None = LEFT) -> DataFrame:
    """docs with their texts redacted, all columns kept; a null text stays null."""
    found, listed = _flagged(docs, text_col, threshold, left)
    if listed is not None:
        # one function finds the spans and cuts them out: a second one would be a second Python process for each task
        @F.pandas_udf("string")
        def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series([t if not t else redact(t, [{"kind": k, "start": s, "end": e} for k, s, e in all_spans(t, listed.value)]) for t in batch], dtype=object)

        return docs.withColumn(text_col, cut(F.col(text_col)))
    spans = free_name(docs, "_spans")
    out = _joined_spans(docs, text_col, spans, found)

    @F.pandas_udf("string")
    def of(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not len(f) else redact(t, f) for t, f in zip(texts, found, strict=True)], dtype=object)

    return out.withColumn(text_col, of(F.col(text_col), F.col(spans))).drop(spans)
