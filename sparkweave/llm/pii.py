"""Personal data: patterns for direct identifiers, and corpus statistics for the terms that give them away."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from sparkweave.llm.common import BLANK, WORD, ascii_lower, broadcast_within, let, row_identity, same_row
from sparkweave.operators.graphs import connected_components
from sparkweave.sources.files import stored

KINDS = ("email", "ip", "card", "phone", "term")
# The contract's patterns. A run of local-part characters or digits is entered at its start only (or where the
# last match ended), and loops never give back, so a long run costs its length and not its square.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A cheap test without which the pattern cannot match.
GUARDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: t.contains("+"),
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": lambda m: F.char_length(_digits(m)).between(14, 19) & F.call_function("luhn_check", _digits(m)),
    "phone": lambda m: F.char_length(_digits(m)).between(10, 15),
}
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"  # letters and everything beyond ASCII
_EDGE = r"[\x21-\x3F\x5B-\x60\x7B-\x7E]"  # punctuation and digits, but not @
WORD_TERM = rf"^{_EDGE}*?({TERM}+)[\x21-\x2F\x3A-\x3F\x5B-\x60\x7B-\x7E]*$"
BLOCK = 64


def _places(text: Column, pattern: str) -> Column:
    """Array of ``struct(value, start)`` of all matches, in code points.

    The text between the matches gives their places. Running lengths go by blocks, so many matches in one text
    cost about ``BLOCK`` additions each.
    """

    def total(lengths, first, n):
        return F.aggregate(F.slice(lengths, first, n), F.lit(0), lambda s, x: s + x)

    def lengths(v):  # n: from the end of the match before to the end of this one
        ends = F.transform(v["m"], lambda x, i: F.get(v["g"], i) + F.char_length(x))
        return F.struct(v["m"].alias("m"), v["g"].alias("g"), ends.alias("n"))

    def blocks(v):  # b: length of each block of matches
        last = F.floor((F.size(v["n"]) - 1) / BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: total(v["n"], k * BLOCK + 1, F.lit(BLOCK)))
        return F.struct(v["m"].alias("m"), v["g"].alias("g"), v["n"].alias("n"), sums.alias("b"))

    def offsets(v):  # b: where each block begins
        starts = F.transform(v["b"], lambda x, k: total(v["b"], F.lit(1), k))
        return F.struct(v["m"].alias("m"), v["g"].alias("g"), v["n"].alias("n"), starts.alias("b"))

    def found(v):
        def one(x, i):
            block = F.floor(i / BLOCK).cast("int")
            return F.struct(x.alias("value"), (F.get(v["b"], block) + F.get(v["g"], i) + total(v["n"], block * BLOCK + 1, i % BLOCK)).alias("start"))

        return F.transform(v["m"], one)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    return let(let(let(let(F.struct(matches.alias("m"), between.alias("g")), lengths), blocks), offsets), found)


def _kept(kind: str) -> Column:
    """The valid matches of a kind as spans."""
    return F.transform(F.filter(f"_{kind}", lambda x: VALID[kind](x["value"])), lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
        (x["start"] + F.char_length(x["value"])).alias("end"), x["value"].alias("value"),
    ))


SPANS = "array<struct<start: int, kind: int, end: int, value: string>>"


def base_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id, _print, _t, spans``: direct identifiers of the whole text, by start and then kind; null text is empty."""
    text = F.coalesce(F.col(text), F.lit(""))
    out = docs.select(*row_identity(F.col(doc_id), text), text.alias("_t"))
    for kind, pattern in PATTERNS.items():
        found = F.when(GUARDS[kind](F.col("_t")), _places(F.col("_t"), pattern))
        out = out.withColumn(f"_{kind}", F.coalesce(found, F.expr("cast(array() AS array<struct<value: string, start: int>>)")))
    return out.select("_id", "_print", "_t", F.array_sort(F.concat(*[_kept(k) for k in PATTERNS])).alias("spans"))


def _entity(span: Column) -> Column:
    """The protected value behind a span: letter case and the separators of numbers do not matter."""
    number = span["kind"].isin(KINDS.index("card"), KINDS.index("phone"))
    return F.concat_ws(":", span["kind"].cast("string"), F.when(number, _digits(span["value"])).otherwise(ascii_lower(span["value"])))


def _entities(span: Column) -> Column:
    """The protected values behind a span: its own and the wider one, a mailbox domain, a network or a number without its last four digits."""
    value, digits = ascii_lower(span["value"]), _digits(span["value"])
    wide = F.when(span["kind"] == KINDS.index("email"), F.regexp_extract(value, "@(.*)$", 1))
    wide = wide.when(span["kind"] == KINDS.index("ip"), F.regexp_extract(value, r"^(.*)\.", 1))
    wide = wide.otherwise(F.substring(digits, F.lit(1), F.char_length(digits) - 4))
    return F.array(_entity(span), F.concat_ws(":", F.lit("wide"), span["kind"].cast("string"), wide))


def _terms(text: Column) -> Column:
    """Distinct lower-case terms: words of letters, without the punctuation around them and never with digits inside."""
    words = F.split(ascii_lower(text), f"{BLANK}+")
    return F.array_remove(F.array_distinct(F.transform(words, lambda w: F.regexp_extract(w, WORD_TERM, 1))), "")


def _term_places(df: DataFrame, text: str) -> DataFrame:
    """Add ``_terms``: array of ``struct(value, start)`` of every term occurrence, as written."""
    edge = rf"^({_EDGE}*?){TERM}+[\x21-\x2F\x3A-\x3F\x5B-\x60\x7B-\x7E]*$"
    inner = F.transform(_places(F.col(text), WORD), lambda x: F.struct(
        F.regexp_extract(x["value"], WORD_TERM, 1).alias("value"),
        (x["start"] + F.char_length(F.regexp_extract(x["value"], edge, 1))).alias("start"),
    ))
    return df.withColumn("_terms", F.filter(inner, lambda x: x["value"] != ""))


def _shingles(text: Column) -> Column:
    """Distinct hashes of the runs of five words; a shorter text is one run."""
    words = F.array_remove(F.split(ascii_lower(text), f"{BLANK}+"), "")

    def runs(w):
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 5, F.lit(0)))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)])))

    return let(words, runs)


def _leader_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's leader; the join back is one that adaptive execution splits at a hot bucket."""
    rank = F.struct(F.xxhash64("node").alias("h"), "node")
    lead = members.groupBy("sig").agg(F.min(rank).alias("l"), F.max(rank).alias("r")).filter("l <> r").select("sig", F.col("l.node").alias("_lead"))
    met = members.join(lead, "sig").filter("node <> _lead")
    return met.select(F.least("node", "_lead").alias("a"), F.greatest("node", "_lead").alias("b")).distinct()


def _families(texts: DataFrame) -> DataFrame:
    """``node, family`` for texts (``_print, _t``, each once) that have near copies: half or more of their runs of five words in common.

    Sets that link share one of the rarest half of their runs, so every link is a meeting there, verified on the whole
    sets. As in the n-gram join, members first meet a leader and those left apart then meet each other.
    """
    sets = stored(texts.select(F.col("_print").alias("node"), _shingles(F.col("_t")).alias("s")), "family-sets")
    runs = sets.select("node", F.size("s").alias("n"), F.explode("s").alias("sig"))
    shared = runs.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    lists = runs.join(shared, "sig").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("c", "sig"))).alias("l"))
    # the prefix is half of the set and one more; runs of one text only come first in it and meet nothing
    take = F.floor(F.col("n") / 2).cast("int") + 1 - (F.col("n") - F.size("l"))
    members = stored(lists.filter(take > 0).select("node", F.explode(F.slice("l", F.lit(1), take)).alias("x")).select("x.sig", "node"), "family-members")

    done = links = comps = None
    labelled = members.withColumn("comp", F.col("node"))
    for turn in range(2):
        if turn == 0:
            pairs = _leader_pairs(members)
        else:
            left, right = (labelled.select("sig", F.col("node").alias(x), F.col("comp").alias(f"_c{x}")) for x in "ab")
            pairs = left.join(right, "sig").filter("a < b AND _ca <> _cb").select("a", "b").distinct().join(done, ["a", "b"], "left_anti")
        done = pairs = stored(pairs, "family-pairs")
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("_b")), "b")
        alike = 3 * F.size(F.array_intersect("_a", "_b")) >= F.size("_a") + F.size("_b")
        found = stored(both.filter(alike).select("a", "b"), "family-links")
        if comps is not None and found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        comps = stored(connected_components(links), "families")
        labelled = members.join(comps, "node", "left").select("sig", "node", F.coalesce("component", "node").alias("comp"))
    return comps.select("node", F.col("component").alias("family"))


def revealing_terms(spans: DataFrame, docs: DataFrame, alpha: float = 0.95, risk: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """``term, strength``: terms whose presence discloses a protected entity; and ``_print, term``: where such terms can be.

    With n(.) counted over all documents, PMI(e; t) = log2(n(e, t) N / (n(e) n(t))) is what term t tells about
    entity e, and IC(e) = log2(N / n(e)) is all there is to tell. A term is revealing if PMI reaches ``alpha`` of
    IC for some entity. A term meets every entity of its text; terms and entities that cannot be evidence are left
    out before they meet. Protected are also wider entities (see ``_entities``). Near copies among the documents with identifiers are a family, and every
    count takes a family once. Evidence must be beyond chance: if term and entity were independent, n(e, t) would be
    about Poisson with mean n(e) n(t) / N, and its tail, times all pairs that the texts hold, must stay within ``risk``.
    So two documents are enough in a large corpus; one never is, as each of its rare words would count.

    ``spans``: stored ``_id, _print, spans`` of documents with identifiers. ``docs``: ``_id, _print, _t``.
    """
    n_docs = docs.agg(F.count(F.lit(1))).first()[0]
    keys = broadcast_within(spans.select("_id", "_print").distinct())
    rows = stored(docs.join(keys, same_row(docs, keys), "left_semi").groupBy("_print").agg(F.count(F.lit(1)).alias("n_rows"), F.first("_t").alias("_t")), "held-texts")
    families = broadcast_within(_families(rows.select("_print", "_t")))
    # one row per text: equal texts have equal spans and terms
    held = rows.join(families, F.col("_print") == F.col("node"), "left").withColumn("family", F.coalesce("family", "_print")).drop("node")
    held = stored(held.withColumn("_held_terms", _terms(F.col("_t"))), "held")
    n_rows, n_families = held.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.count_distinct("family")).first()
    n_docs += n_families - n_rows
    terms = held.select("family", "n_rows", F.explode("_held_terms").alias("term"))
    terms = terms.groupBy("term", "family").agg(F.sum("n_rows").alias("n_rows"))
    near = stored(
        terms.groupBy("term").agg(F.count(F.lit(1)).alias("n_held"), F.sum("n_rows").alias("n_rows")).filter("n_held > 1"),
        "terms-held",
    )
    # the one pass that cuts all texts into terms; where a term is found is looked up here afterwards
    found = docs.select("_print", F.explode(_terms(F.col("_t"))).alias("term")).join(broadcast_within(near.select("term")), "term")
    found = stored(found.select("_print", "term"), "terms-found")
    counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("n_all")).join(near, "term")
    counts = counts.select("term", "n_held", (F.col("n_all") - F.col("n_rows") + F.col("n_held")).alias("n_term"))
    # no entity can be told by a term more often than any is, so most terms end here
    least = F.pow(F.lit(2.0), F.lit(-(1 - alpha)) * F.log2(F.lit(float(max(n_docs, 2)))))
    likely = stored(counts.filter(F.col("n_held") >= least * F.col("n_term")).select("term", "n_term"), "terms-likely")

    by_text = spans.select("_print", "spans").dropDuplicates(["_print"]).join(held.select("_print", "family"), "_print")
    entities = by_text.select("_print", "family", F.explode("spans").alias("s")).select("_print", "family", F.explode(_entities(F.col("s"))).alias("entity")).distinct()
    sizes = entities.groupBy("_print").agg(F.count(F.lit(1)).alias("n")).join(held.select("_print", "family", F.size("_held_terms").alias("m")), "_print")
    n_pairs = sizes.groupBy("family").agg(F.max(F.col("n") * F.col("m")).alias("n")).agg(F.sum("n")).first()[0] or 0
    n_entity = entities.select("family", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))

    entities = stored(entities.join(n_entity.filter("n_entity > 1").select("entity"), "entity"), "entities")
    # each likely term of a text meets each entity of it that more than one family holds
    seen = held.select("_print", F.explode("_held_terms").alias("term")).join(broadcast_within(likely.select("term")), "term")
    pairs = seen.join(entities, "_print").select("family", "term", "entity").distinct()
    joint = pairs.groupBy("term", "entity").agg(F.count(F.lit(1)).alias("n_both"))
    judged = joint.filter("n_both > 1").join(n_entity, "entity").join(likely, "term")
    total = F.lit(float(n_docs))
    # log of mean^k / k!, which is no less than the tail; the factorial by Stirling's lower bound
    k, mean = F.col("n_both"), F.col("n_entity") * F.col("n_term") / total
    tail = k * (1 + F.log(mean / k)) - F.log(2 * math.pi * k) / 2
    judged = judged.filter(tail + math.log(max(n_pairs, 1)) <= math.log(risk))
    pmi = F.log2(F.col("n_both") * total / (F.col("n_entity") * F.col("n_term")))
    content = F.log2(total / F.col("n_entity"))
    strength = F.when(content > 0, F.least(pmi / content, F.lit(1.0)))
    return judged.groupBy("term").agg(F.max(strength).alias("strength")).filter(F.col("strength") >= alpha), found


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", alpha: float = 0.95, risk: float = 0.05) -> DataFrame:
    """``_id, _print, spans``, one row per document: direct identifiers and revealing terms, by start and then kind.

    Spans are ``struct(start, kind, end, value)`` in code points, the end exclusive, ``kind`` an index into ``KINDS``.
    A revealing term is marked wherever it occurs in the corpus, also without the entity. Spans of kind ``term``
    carry ``removed`` or ``generalised`` as value: removed where the term tells the entity for certain.

    Defined cases: null or empty text has no spans; repeated rows have equal spans; null ids are ids; an empty table
    gives no rows; a text that is all digits or all one word costs its length. Only the named columns are read.
    """
    base = base_spans(docs, doc_id, text)
    held = stored(base.filter(F.size("spans") > 0).select("_id", "_print", "spans").dropDuplicates(["_id", "_print"]), "identifiers")
    clean = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(*row_identity(F.col(doc_id), clean), clean.alias("_t"))
    revealing, found = revealing_terms(held, texts, alpha, risk)
    terms = broadcast_within(stored(revealing, "revealing"))

    where = broadcast_within(stored(found.join(terms.select("term"), "term").select("_print").distinct(), "marked"))
    some = texts.join(where, "_print", "left_semi").dropDuplicates(["_id", "_print"])
    places = _term_places(some, "_t").select("_id", "_print", F.inline("_terms")).withColumn("term", ascii_lower(F.col("value")))
    hits = places.join(terms, "term")
    action = F.when(F.col("strength") >= 1.0, "removed").otherwise("generalised")
    spans = hits.groupBy("_id", "_print").agg(F.collect_list(F.struct(
        F.col("start"), F.lit(KINDS.index("term")).alias("kind"), (F.col("start") + F.char_length("value")).alias("end"), action.alias("value"),
    )).alias("spans"))
    all_spans = held.unionByName(spans).groupBy("_id", "_print").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    all_spans = all_spans.select(F.col("_id").alias("_sid"), F.col("_print").alias("_sprint"), "spans")
    rows = docs.select(*row_identity(F.col(doc_id), clean))
    joined = rows.join(all_spans, rows["_id"].eqNullSafe(all_spans["_sid"]) & (rows["_print"] == all_spans["_sprint"]), "left")
    return joined.select("_id", "_print", F.coalesce("spans", F.expr(f"cast(array() AS {SPANS})")).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The documents with identifiers replaced by ``[KIND]``, revealing terms by ``[TERM]`` or nothing.

    All columns stay; ``n_chars``, if there is one, follows the new text. Overlapping spans become one mark, that
    of the first. Rows without spans, and null texts, stay as they are.
    """
    spans = find(docs, doc_id, text, **limits).filter(F.size("spans") > 0).dropDuplicates(["_id", "_print"])
    spans = spans.select(F.col("_id").alias("_llm_id"), F.col("_print").alias("_llm_print"), F.col("spans").alias("_llm_spans"))
    width = F.aggregate("_llm_spans", F.lit(0).cast("bigint"), lambda n, s: n + 64 + F.octet_length(s["value"]))
    spans = broadcast_within(stored(spans, "spans"), more=width)
    same = F.col(doc_id).eqNullSafe(spans["_llm_id"]) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == spans["_llm_print"])
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    # the end so far and the pieces of the new text
    pieces = F.expr(
        f"""aggregate(_llm_spans, struct(0 AS at, '' AS done), (acc, s) -> CASE WHEN s.start < acc.at
              THEN struct(greatest(acc.at, s.end) AS at, acc.done AS done)
              ELSE struct(s.end AS at, concat(acc.done, substring(`{text}`, acc.at + 1, s.start - acc.at),
                   CASE WHEN s.value = 'removed' AND s.kind = {KINDS.index("term")} THEN '' ELSE get(array({names}), s.kind) END) AS done) END,
              acc -> concat(acc.done, substring(`{text}`, acc.at + 1)))"""
    )
    out = docs.join(spans, same, "left").withColumn("_llm_text", F.when(F.col("_llm_id").isNull() & F.col("_llm_spans").isNull(), F.col(text)).otherwise(pieces))
    changed = {text: F.col("_llm_text")}
    if "n_chars" in docs.columns:
        length = F.char_length("_llm_text").cast(dict(docs.dtypes)["n_chars"])
        changed["n_chars"] = F.when(F.col("_llm_spans").isNull(), F.col("n_chars")).otherwise(length)
    return out.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])

