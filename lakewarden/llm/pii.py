"""Operator 7 [native]: personal data by fixed forms and by bootstrapped contextual extraction.

Base entities (email, ip, card, phone) are found by form. They seed the bootstrap, and so do long mixed strings of
letters and digits, as keys and access tokens are, though these are reported only where a pattern says so. The words beside an entity are its
lexical patterns: one or two words before it, one or two after it, and one on either side. Every other token with
digits is an instance in the patterns around it. Patterns and instances score each other in rounds over their graph: a
pattern by the share of its occurrences that score, an instance by the mean of the patterns that seeds support. After
each round the tokens that look like identifiers and stand in a pattern of high confidence are new entities, of the
kind `id`, and seeds of the next round; scores only grow, and rounds go on until one finds no further confident pattern.
All of it is DataFrame functions; texts are read once and only spans and
hashes are shuffled. The work on a text is linear in its length, but for a small factor.

Offsets are code points: the gaps between matches, which `split` gives, and the matches themselves add up to them.

Defined results: a null text counts as empty; null and repeated ids and repeated rows keep their rows, as spans go by
id and text. Base spans of one kind never overlap, spans of different kinds may; an `id` never overlaps a base span.
Ties of position go by kind in order of name. Other columns are never read, and may have any names; whole texts are,
and a neighbouring word counts whole however long it is. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

KINDS = ("email", "ip", "card", "phone")
#: Fixed forms. Possessive repeats and the conditions before a match keep the work linear; they match the same places.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Rounds before which the search doesn't end, as scores first have to spread.
LEAST_ROUNDS = 3
#: Matches of a text that are added up at a time, so that no array is copied for each match.
PART = 256
#: Spans of a text above which it is cut into characters once instead of being searched for each of them.
MANY = 64
#: Marks of what matches and of what fails in a masked text, and what they become where a text holds them itself.
HIT, MISS, OTHER = "\x01", "\x02", "\x03"
#: A pattern is confident with so many occurrences of seeds, this score, and this share of identifiers among the rest.
SUPPORT, CONFIDENT = 8, 0.6
#: Form of a secret that seeds patterns.
SECRET = r"^(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9+/_-]{32,}$"
#: Least length and digits of a new identifier.
LENGTH, DIGITS = 8, 4


SPANS = "array<struct<s: int, e: int, m: string>>"


def _spans(x: Column) -> Column:
    """Matches m and gaps g as spans with their code point offsets."""
    parts = F.sequence(F.lit(0), F.floor((F.size(x["m"]) - 1) / PART).cast("int"))

    def each(part: Column) -> Column:
        return F.sequence(part * PART, F.least(part * PART + PART, F.size(x["m"])) - 1)

    def length(i: Column) -> Column:
        return F.length(F.get(x["g"], i)) + F.length(F.get(x["m"], i))

    totals = F.transform(parts, lambda part: F.aggregate(each(part), F.lit(0), lambda acc, i: acc + length(i)))
    starts = F.aggregate(totals, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))

    def add(acc: Column, i: Column) -> Column:
        s = acc["at"] + F.length(F.get(x["g"], i))
        m = F.get(x["m"], i)
        e = s + F.length(m)
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), m.alias("m")))).alias("out"))

    def spans(part: Column, start: Column) -> Column:
        return F.aggregate(each(part), F.struct(start.alias("at"), F.array().cast(SPANS).alias("out")), add)["out"]

    return F.flatten(F.transform(F.array(starts), lambda at: F.transform(parts, lambda part: spans(part, F.get(at, part))))[0])


def _pair(text: Column, regex: str) -> Column:
    return F.array(F.struct(F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("m"), F.split(text, regex, -1).alias("g")))


def _located(text: Column, regex: str, judge=None) -> Column:
    """struct<spans, masked>: the matches that judge accepts, all without one, with their code point offsets, and the
    text with what isn't white space in accepted matches as HIT, in others as MISS; null without a match.
    """
    fits = judge or (lambda m: F.lit(True))

    def mask(m: Column) -> Column:
        return F.when(fits(m), F.regexp_replace(m, r"\S", HIT)).otherwise(F.regexp_replace(m, r"\S", MISS))

    def both(x: Column) -> Column:
        masked = F.array_join(F.transform(x["g"], lambda gap, i: F.concat(gap, F.coalesce(mask(F.get(x["m"], i)), F.lit("")))), "")
        return F.struct(F.filter(_spans(x), lambda span: fits(span["m"])).alias("spans"), masked.alias("masked"))

    return F.when(F.regexp_like(text, F.lit(regex)), F.transform(_pair(text, regex), both)[0])


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, i, 1).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _base(text: Column) -> dict[str, Column]:
    """Spans and masked text of each base kind, null where the kind has no match at all."""
    small = lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
    digit = F.regexp_like(text, F.lit("[0-9]"))
    return {
        "email": F.when(F.contains(text, F.lit("@")), _located(text, EMAIL)),
        "ip": F.when(digit, _located(text, IP, lambda m: F.forall(F.split(m, r"\."), small))),
        "card": F.when(digit, _located(text, CARD, lambda m: _luhn(_digits(m)))),
        "phone": F.when(F.contains(text, F.lit("+")), _located(text, PHONE, lambda m: F.length(_digits(m)).between(8, 15))),
    }


def _each(kind: str, make) -> Column:
    """transform() over the spans of a kind; make takes the kind's name and a span."""
    return F.transform(F.col(kind), lambda x: make(kind, x))


def _text_of(kinds) -> Column:
    return F.array_join(F.concat(*(_each(k, lambda name, x: F.concat_ws(":", F.lit(name), x["s"], x["e"])) for k in kinds)), ",")


def _identifier(core: Column, failed: Column) -> Column:
    # a failed card or address is no identifier unless it has letters
    return (F.length(core) >= LENGTH) & (F.length(_digits(core)) >= DIGITS) & (F.regexp_like(core, F.lit(r"\p{L}")) | ~failed)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, rid, email, ip, card, phone, slots): spans of each base kind, and the tokens with digits or in a base span.

    A slot is a token without the marks around it, its hash, whether it is a seed and whether it looks like an
    identifier, and the hashes of the patterns around it.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    rows = rows.select("doc_id", F.xxhash64("t").alias("rid"), F.translate("t", HIT + MISS, OTHER + OTHER).alias("t"))
    t = F.col("t")
    rows = rows.select("*", *(c.alias(f"own_{k}") for k, c in _base(t).items()))
    any_digit = F.regexp_like(t, F.lit("[0-9]"))
    masks = [F.when(F.col(f"own_{k}").isNotNull(), F.regexp_extract_all(F.col(f"own_{k}.masked"), F.lit(r"\S+"), F.lit(0))).alias(k) for k in KINDS]
    held = any_digit | F.col("own_email").isNotNull()
    tokens = F.when(held, F.transform(_pair(t, r"\S+"), _spans)[0])
    parts = F.array(F.struct(tokens.alias("t"), *masks))

    def slots(x: Column) -> Column:
        def marked(i: Column, mark: str, kinds=KINDS) -> Column:
            out = F.lit(False)
            for k in kinds:
                out |= F.coalesce(F.contains(F.get(x[k], i), F.lit(mark)), F.lit(False))
            return out

        def word(i: Column) -> Column:
            return F.when((i >= 0) & (i < F.size(x["t"])), F.lower(F.get(x["t"], i)["m"]))

        def patterns(i: Column, seed: Column) -> Column:
            # the tokens of one entity are no context of each other
            l1, r1 = (F.when(~(seed & marked(j, HIT)), word(j)) for j in (i - 1, i + 1))
            l2, r2 = F.when(l1.isNotNull(), word(i - 2)), F.when(r1.isNotNull(), word(i + 2))
            found = [("l", l1), ("r", r1), ("ll", l2, l1), ("rr", r1, r2), ("lr", l1, r1)]
            hashes = []
            for name, *words in found:
                there = F.lit(True)
                for w in words:
                    there &= w.isNotNull()
                hashes.append(F.when(there, F.xxhash64(F.lit(name), *words)))
            return F.array_compact(F.array(*hashes))

        def slot(i: Column) -> Column:
            m = F.get(x["t"], i)
            lead = F.length(F.regexp_extract(m["m"], r"^[^\p{L}\p{N}]*", 0))
            core = F.regexp_replace(m["m"], r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
            s = m["s"] + lead
            seed, failed = marked(i, HIT), marked(i, MISS, ("ip", "card"))
            sure = seed | F.regexp_like(core, F.lit(SECRET))
            return F.struct(s.alias("s"), (s + F.length(core)).alias("e"), core.alias("m"), F.xxhash64(core).alias("instance"), sure.alias("seed"), (~seed & _identifier(core, failed)).alias("like"), patterns(i, seed).alias("patterns"))

        wanted = F.filter(F.sequence(F.lit(0), F.size(x["t"]) - 1), lambda i: F.regexp_like(F.get(x["t"], i)["m"], F.lit("[0-9]")) | marked(i, HIT))
        return F.when(F.size(x["t"]) > 0, F.transform(wanted, slot))

    rows = rows.withColumn("slots", F.when(held, F.transform(parts, slots)[0]))
    return rows.select("doc_id", "rid", *(F.coalesce(F.col(f"own_{k}.spans"), F.array().cast(SPANS)).alias(k) for k in KINDS), "slots")


def confident_patterns(slots: DataFrame, tables: Scratch) -> DataFrame:
    """(pattern) of the patterns that are confident once a round over the pattern-instance graph finds no more of them."""
    edges = slots.select("instance", "seed", "like", F.explode("patterns").alias("pattern"))
    edges = tables.write(edges.groupBy("pattern", "instance").agg(F.count("*").alias("c"), F.max("seed").alias("seed"), F.max("like").alias("like")))
    score = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("s"))
    confident = (F.col("support") >= SUPPORT) & (F.col("p") >= CONFIDENT)
    before, n, rounds = None, -1, 0
    while True:
        sure = F.when(F.col("s") == 1, F.col("c")).otherwise(0)
        patterns = edges.join(score, "instance").groupBy("pattern").agg((F.sum(F.col("c") * F.col("s")) / F.sum("c")).alias("p"), F.sum(sure).alias("support"))
        patterns = tables.write(patterns.where("support > 0"))
        if before is not None:
            tables.drop(before)
        before, rounds, found = patterns, rounds + 1, patterns.where(confident).count()
        if rounds >= LEAST_ROUNDS and found == n:
            return patterns.where(confident).select("pattern")
        n = found
        met = edges.join(patterns.withColumn("sure", confident), "pattern", "left").groupBy("instance")
        score = met.agg(F.max(F.col("seed") | (F.col("like") & F.coalesce("sure", F.lit(False)))).alias("known"), (F.sum(F.col("c") * F.coalesce("p", F.lit(0.0))) / F.sum("c")).alias("m"))
        score = score.select("instance", F.when(F.col("known"), 1.0).otherwise(F.least("m", F.lit(0.999))).alias("s"))


def discover(scanned: DataFrame, tables: Scratch) -> DataFrame:
    """(doc_id, rid, id): spans of identifiers in slots of confident patterns, in order."""
    slots = scanned.where(F.size("slots") > 0).select("doc_id", "rid", F.explode("slots").alias("x")).select("doc_id", "rid", "x.*")
    patterns = confident_patterns(slots, tables)
    both = slots.where("like").select("doc_id", "rid", "s", "e", "m", F.explode("patterns").alias("pattern"))
    found = both.join(patterns, "pattern")
    return found.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_set(F.struct("s", "e", "m"))).alias("id"))


def with_found(scanned: DataFrame, tables: Scratch) -> DataFrame:
    found = discover(scanned, tables).toDF("k", "h", "id")
    own = scanned.drop("slots")
    out = own.join(found, own.doc_id.eqNullSafe(found.k) & (own.rid == found.h), "left").drop("k", "h")
    return out.withColumn("id", F.coalesce("id", F.array().cast(SPANS)))


def find_entities(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id) of every row."""
    with Scratch() as tables:
        return tables.keep(_described(with_found(tables.write(scan(docs, key, text)), tables)))


def _described(rows: DataFrame) -> DataFrame:
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(_text_of(KINDS), 256).alias("base_sha256"), _text_of((*KINDS, "id")).alias("spans"), F.size("id").cast("long").alias("n_id"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the text of every entity replaced by its kind in brackets; of entities that overlap one another the
    whole stretch is replaced, by the kind of the first.
    """
    with Scratch() as tables:
        spans = tables.keep(_spans_of(with_found(tables.write(scan(docs, key, text)), tables)))
    return _replaced(docs, spans, key, text)


def _spans_of(scanned: DataFrame) -> DataFrame:
    """(lw:key, lw:rid, lw:spans): of each text with entities the stretches to replace, in order."""
    tagged = F.concat(*(_each(k, lambda name, x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(f"[{name.upper()}]").alias("m"))) for k in (*KINDS, "id")))
    spans = scanned.select(F.struct("doc_id", "rid").alias("of"), F.explode(tagged).alias("x")).select("of", "x.*").distinct()
    order = Window.partitionBy("of").orderBy("s", "e", "m")  # the spans of one text
    spans = spans.withColumn("before", F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("nth", F.count(F.when(F.col("before").isNull() | (F.col("s") >= F.col("before")), 1)).over(order))
    spans = spans.groupBy("of", "nth").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min_by("m", F.struct("s", "e", "m")).alias("m"))
    spans = spans.groupBy("of").agg(F.array_sort(F.collect_list(F.struct("s", "e", "m"))).alias("lw:spans"))
    return spans.select(F.col("of.doc_id").alias("lw:key"), F.col("of.rid").alias("lw:rid"), "lw:spans")


def _replaced(docs: DataFrame, spans: DataFrame, key: str, text: str) -> DataFrame:
    names = docs.columns
    rows = docs.withColumn("lw:hash", F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    # by a shuffle at every size: how many texts have entities isn't bounded
    rows = rows.join(spans.hint("merge"), F.col(key).eqNullSafe(F.col("lw:key")) & (F.col("lw:hash") == F.col("lw:rid")), "left")

    def rebuilt(piece) -> Column:
        def build(at: Column) -> Column:
            ends = F.concat(F.array(F.lit(0)), F.transform(at, lambda y: y["e"]))
            return F.array_join(F.transform(ends, lambda end, i: F.concat(piece(end, F.get(at, i)["s"]), F.coalesce(F.get(at, i)["m"], F.lit("")))), "")

        return F.transform(F.array("lw:spans"), build)[0]

    def substring(end: Column, start: Column) -> Column:
        return F.substring(F.col(text), end + 1, F.coalesce(start, F.length(text)) - end)

    # a substring is searched from the front of a text: for many spans the text becomes an array of characters
    def sliced(chars: Column):
        return lambda end, start: F.array_join(F.slice(chars, end + 1, F.coalesce(start, F.size(chars)) - end), "")

    by_chars = F.transform(F.array(F.split(F.col(text), "")), lambda chars: rebuilt(sliced(chars)))[0]
    done = F.when(F.size("lw:spans") > MANY, by_chars).otherwise(rebuilt(substring))
    return rows.select(*(F.when(F.col("lw:spans").isNull(), F.col(text)).otherwise(done).alias(c) if c == text else F.col(c) for c in names))
