"""Personal data: fixed patterns, and terms that reveal them by what the corpus tells.

Patterns find the base spans. Each distinct base value is a protected entity. Over the corpus, a term of a text that
bears an entity carries information about it: with n the number of distinct texts,

    IC(e) = log2(n / n(e)),   PMI(e, t) = log2(n n(e, t) / (n(e) n(t))),   disclosure = PMI / IC.

Disclosure is 1 when the term occurs with that entity only, so that it names the entity. Terms from ``GENERALISE`` on are
replaced by a general word, from ``REMOVE`` on they are taken out; both wherever they stand in the texts of the entity.

Rarity alone reveals nobody, or every rare word beside an address would go. So a term has to look like a name or a number
in some bearing text: with a digit, or with a capital that no start of a sentence explains, in a text in which capitals are
not the rule. Words of scripts without capitals need an entity of two texts instead. And a term that may have met the entity by
chance stays: Hoeffding's bound on the chance that as many of the term's n(t) texts bear the entity, times the number of
terms tried for that entity, has to be at most ``CHANCE``. No number of texts is asked for, so a rare name beside an entity of
one text counts, and in a small corpus a name seen once beside a frequent entity does not.

DataFrame operations only. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed

# Texts that have to show a pair; one will do, chance decides. For words of scripts without capitals it takes two.
SUPPORT, SUPPORT_PLAIN = 1, 2
CHANCE = 0.05
GENERALISE, REMOVE = 0.75, 0.95
# Words that positions are summed over at a time, as an array grows by copying.
BLOCK = 256
# Rows of which a join side may be broadcast; larger sides are shuffled.
BROADCAST_ROWS = 500_000
# The patterns of the contract, written so that they find the same spans without trying a run of characters from each
# of its places: runs are possessive where what follows cannot be part of them, and a run is only tried from its start
# (or from where the last match ended). The card pattern holds the digit count, for a match takes the whole run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
# A character without which a pattern cannot match; such texts are passed over.
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
WORD = r"[\p{L}\p{N}]+"
# Stands for each character of a base span; a private-use one, which a text's own is blanked for.
COVER = "\ue000"
FREE_WORD = rf"(?<![{COVER}\p{{L}}\p{{N}}])[\p{{L}}\p{{N}}]++(?!{COVER})"
# Free words that look like names or numbers: a capital away from the start of a sentence, or a digit.
CAPITAL = rf"(?<![{COVER}\p{{L}}\p{{N}}])(?<!^)(?<![.!?:\n][\s\"'(]{{0,3}})\p{{Lu}}[\p{{L}}\p{{N}}]*+(?!{COVER})"
NUMBER = rf"(?<![{COVER}\p{{L}}\p{{N}}])\p{{L}}*+\p{{N}}[\p{{L}}\p{{N}}]*+(?!{COVER})"
# Any capitalised word, to see whether capitals are the rule in a text; words without any cased letter.
UPPER = r"^\p{Lu}"
CASELESS = r"^[\p{Lo}\p{M}]+$"
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "general": "[TERM]", "remove": ""}
SPAN = "struct<start:int,rank:int,kind:string,stop:int,value:string>"


def positions(found: str, between: str, kind: str, rank: int) -> str:
    """Spans from the matches and the text between them."""
    return f"""
    CASE WHEN size({found}) > 0 THEN aggregate(
      sequence(1, size({found})),
      named_struct('at', 0, 'out', CAST(array() AS array<{SPAN}>)),
      (acc, i) -> named_struct(
        'at', acc.at + length({between}[i - 1]) + length({found}[i - 1]),
        'out', array_append(acc.out, named_struct(
          'start', acc.at + length({between}[i - 1]), 'rank', {rank}, 'kind', '{kind}',
          'stop', acc.at + length({between}[i - 1]) + length({found}[i - 1]), 'value', {found}[i - 1]))),
      acc -> acc.out) ELSE CAST(array() AS array<{SPAN}>) END
    """


DIGITS = "regexp_replace(s.value, '[^0-9]', '')"
LUHN = f"""
aggregate(sequence(1, length({DIGITS})), 0, (sum, i) -> sum +
  CASE WHEN i % 2 = 1 THEN CAST(substring({DIGITS}, -i, 1) AS int)
       WHEN CAST(substring({DIGITS}, -i, 1) AS int) > 4 THEN 2 * CAST(substring({DIGITS}, -i, 1) AS int) - 9
       ELSE 2 * CAST(substring({DIGITS}, -i, 1) AS int) END) % 10 = 0
"""
VALID = {
    "email": "true",
    "ip": "forall(split(s.value, '[.]'), x -> CASE WHEN x RLIKE '^0*[0-9]{1,3}$' THEN CAST(regexp_extract(x, '^0*([0-9]{1,3})$', 1) AS int) <= 255 ELSE false END)",
    "card": LUHN,
    "phone": f"length({DIGITS}) BETWEEN 9 AND 15",
}


def with_base(rows: DataFrame) -> DataFrame:
    """Adds ``base`` (the base spans by start, then kind) and the count of each kind to rows with ``text``.

    Each step is a projection of its own, so that a pattern runs once over a text.
    """
    nothing = F.array().cast("array<string>")
    found = {k: F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0)) for k in KINDS}
    rows = rows.withColumns({f"_m_{k}": F.when(F.contains("text", F.lit(NEEDED[k])), found[k]).otherwise(nothing) if k in NEEDED else found[k] for k in KINDS})
    rows = rows.withColumns({f"_p_{k}": F.when(F.size(f"_m_{k}") > 0, F.split("text", PATTERNS[k], -1)) for k in KINDS})
    rows = rows.withColumns({f"_s_{k}": F.expr(positions(f"_m_{k}", f"_p_{k}", k, i)) for i, k in enumerate(KINDS)})
    rows = rows.withColumns({f"_v_{k}": F.expr(f"filter(_s_{k}, s -> {VALID[k]})") for k in KINDS})
    rows = rows.withColumns({f"n_{k}": F.size(f"_v_{k}").cast("bigint") for k in KINDS})
    rows = rows.withColumn("base", F.sort_array(F.concat(*(f"_v_{k}" for k in KINDS))))
    return rows.drop(*(f"_{x}_{k}" for x in "mpsv" for k in KINDS))


COVERED = f"""
aggregate(base, named_struct('at', 0, 'out', CAST(array() AS array<string>)),
  (acc, s) -> named_struct('at', greatest(acc.at, s.stop), 'out', concat(acc.out, array(
    substring(blank, acc.at + 1, greatest(s.start - acc.at, 0)), repeat('{COVER}', greatest(s.stop - greatest(acc.at, s.start), 0))))),
  acc -> concat(array_join(acc.out, ''), substring(blank, acc.at + 1, length(blank))))
"""


def context_terms(bearing: DataFrame) -> DataFrame:
    """One row for each distinct text: ``text_key``, its ``entities``, and ``covered``, the text without its base spans.

    Covered text has the length of the text. Words that touch a base span are no ``FREE_WORD`` of it.
    """
    texts = bearing.select("text_key", "text", "base").dropDuplicates(["text_key"])
    value = lambda s: F.when(s["kind"] == "email", F.lower(s["value"])).when(s["kind"] == "ip", s["value"]).otherwise(F.regexp_replace(s["value"], "[^0-9]", ""))
    texts = texts.withColumn("entities", F.array_distinct(F.transform("base", lambda s: F.concat_ws(":", s["kind"], value(s)))))
    texts = texts.withColumn("blank", F.translate("text", COVER, " "))
    return texts.select("text_key", "entities", F.expr(COVERED).alias("covered"))


def placed_words(contexts: DataFrame) -> DataFrame:
    """``text_key, term, start, stop`` of every free word of more than one character."""
    words = contexts.select("text_key", F.regexp_extract_all("covered", F.lit(FREE_WORD), F.lit(0)).alias("words"), F.split("covered", FREE_WORD, -1).alias("gaps"))
    words = words.where(F.size("words") > 0).withColumn("steps", F.expr("transform(words, (w, i) -> length(gaps[i]) + length(w))"))
    begins = f"""
    aggregate(sequence(0, CAST((size(words) - 1) div {BLOCK} AS int)), named_struct('at', 0, 'out', CAST(array() AS array<int>)),
      (acc, b) -> named_struct('at', acc.at + aggregate(slice(steps, b * {BLOCK} + 1, {BLOCK}), 0, (x, y) -> x + y), 'out', array_append(acc.out, acc.at)),
      acc -> acc.out)
    """
    blocks = words.withColumn("begins", F.expr(begins))
    block = f"transform(begins, (at, b) -> named_struct('at', at, 'words', slice(words, b * {BLOCK} + 1, {BLOCK}), 'gaps', slice(gaps, b * {BLOCK} + 1, {BLOCK})))"
    blocks = blocks.select("text_key", F.explode(F.expr(block)).alias("b")).select("text_key", "b.at", "b.words", "b.gaps")
    blocks = blocks.withColumn("placed", F.expr(positions("words", "gaps", "term", 0)))
    each = blocks.select("text_key", "at", F.explode("placed").alias("w"))
    each = each.select("text_key", F.lower("w.value").alias("term"), (F.col("at") + F.col("w.start")).alias("start"), (F.col("at") + F.col("w.stop")).alias("stop"))
    return each.where(F.length("term") > 1)


def bounded(side: DataFrame, rows: int | None = None) -> DataFrame:
    return F.broadcast(side) if (side.count() if rows is None else rows) <= BROADCAST_ROWS else side


def rows_of(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))


def formed_words(contexts: DataFrame) -> DataFrame:
    """``text_key, term, form`` of the free words of more than one character, repeated ones too.

    Form 2: looks like a name or number there; 1: of a script without capitals; 0: any other.
    """
    all_of = lambda pattern: F.regexp_extract_all("covered", F.lit(pattern), F.lit(0))
    rows = contexts.select("text_key", all_of(FREE_WORD).alias("words"), all_of(CAPITAL).alias("capitals"), all_of(NUMBER).alias("numbers"))
    rule = F.size(F.filter("words", lambda w: w.rlike(UPPER))) * 2 > F.size("words")
    rows = rows.withColumn("named", F.concat("numbers", F.when(rule, F.array().cast("array<string>")).otherwise(F.col("capitals"))))
    plain = rows.select("text_key", F.explode("words").alias("word")).withColumn("form", F.col("word").rlike(CASELESS).cast("int"))
    named = rows.select("text_key", F.explode("named").alias("word")).withColumn("form", F.lit(2))
    return plain.union(named).select("text_key", F.lower("word").alias("term"), "form").where(F.length("term") > 1)


def weighed(documents: DataFrame, contexts: DataFrame, support: int, least: float, chance: float, named: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, shown pairs by text, and told pairs, from counts over all distinct texts.

    Entities of the same texts have the same disclosures, so they are one ``party``: ``entity, party``; ``text_key,
    party, term``; ``party, term, disclosure`` of the pairs at or above ``least`` that are not likelier than ``chance``.
    The bearing texts in which a term stands are a lower bound of its texts, which gives an upper bound of the
    disclosure. Pairs that cannot reach ``least`` by that, those of common words, are never paired with entities, and
    their words are left out before all texts are searched. ``named`` keeps to terms of a telling form.
    """
    rows = rows_of(documents)
    total = float(rows.select("text_key").distinct().count())
    held = contexts.select("text_key", F.explode("entities").alias("entity"))
    same_texts = F.xxhash64(F.count("*"), F.bit_xor("text_key"), F.sum(F.xxhash64("text_key").cast("decimal(20,0)")))
    entities = checkpointed(held.groupBy("entity").agg(F.count("*").alias("n_entity"), same_texts.alias("party")))
    parties = held.join(bounded(entities), "entity").select("text_key", "party", "n_entity").distinct()
    terms = checkpointed(formed_words(contexts).groupBy("text_key", "term").agg(F.max("form").alias("form")))
    seen = terms.groupBy("term").agg(F.count("*").alias("n_seen"), F.max("form").alias("form"))
    if named:
        seen = seen.where("form > 0")
    terms = terms.drop("form")
    share = F.col("n_entity") / F.lit(total)

    def disclosure(n_term):
        content = -F.log2(share)
        shared = F.log2(F.lit(total) * F.col("both") / (F.col("n_entity") * n_term))
        return F.when(content > 0, shared / content).otherwise(0.0)

    def unlikely(n_term):
        part = F.col("both") / n_term
        rest = F.when(part < 1, (1 - part) * F.log2((1 - part) / (1 - share))).otherwise(0.0)
        surprise = F.when(part > share, n_term * (part * F.log2(part / share) + rest)).otherwise(0.0)
        return surprise >= (F.lit(-math.log2(chance)) + F.log2("tried") if chance < 1 else F.lit(0.0))

    most = F.lit(total) * F.pow(share, F.lit(float(least))) * (1 + 1e-9)
    shown = terms.join(seen, "term").join(parties, "text_key").where(F.col("n_seen") <= most)
    shown = checkpointed(shown.select("text_key", "party", "term", "n_entity", "n_seen", "form"))
    alike = [F.max(c).alias(c) for c in ("n_entity", "n_seen", "form")]
    pairs = checkpointed(shown.groupBy("party", "term").agg(F.count("*").alias("both"), *alike))
    pairs = pairs.join(pairs.groupBy("party").agg(F.count("*").alias("tried")), "party")
    shows = F.when((F.col("form") == 1) & F.lit(named), max(support, SUPPORT_PLAIN)).otherwise(support)
    pairs = pairs.where((F.col("both") >= shows) & (disclosure(F.col("n_seen")) >= least) & unlikely(F.col("n_seen")))
    pairs = checkpointed(pairs)
    if pairs.isEmpty():
        return entities, shown, pairs.select("party", "term", F.lit(0.0).alias("disclosure"))
    wanted = checkpointed(pairs.select("term").distinct())
    words = rows.select("text_key", F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("term"))
    words = words.select("text_key", F.lower("term").alias("term"))
    counts = words.join(bounded(wanted), "term", "left_semi").distinct().groupBy("term").agg(F.count("*").alias("n_term"))
    told = pairs.join(counts, "term", "left").withColumn("n_term", F.greatest("n_term", "n_seen"))
    told = told.where(unlikely(F.col("n_term"))).withColumn("disclosure", disclosure(F.col("n_term")))
    return entities, shown, told.where(F.col("disclosure") >= least).select("party", "term", "disclosure")


def disclosing(documents: DataFrame, contexts: DataFrame, support: int, least: float, chance: float = 1.0) -> DataFrame:
    """``entity, term, disclosure`` of the pairs at or above ``least``."""
    entities, _, told = weighed(documents, contexts, support, least, chance)
    return told.join(entities, "party").select("entity", "term", "disclosure")


def revealing_spans(documents: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE, chance: float = CHANCE) -> DataFrame:
    """``text_key, added``: the spans of revealing terms of each text that has any."""
    bearing = with_base(rows_of(documents)).where(F.size("base") > 0)
    contexts = checkpointed(context_terms(bearing))
    _, shown, told = weighed(documents, contexts, support, generalise, chance, named=True)
    found = shown.join(told, ["party", "term"]).groupBy("text_key", "term").agg(F.max("disclosure").alias("disclosure"))
    spans = placed_words(contexts).join(found, ["text_key", "term"])
    kind = F.when(F.col("disclosure") >= remove, "remove").otherwise("general")
    rank = F.when(F.col("disclosure") >= remove, len(KINDS) + 1).otherwise(len(KINDS))
    span = F.struct("start", rank.alias("rank"), kind.alias("kind"), "stop", F.lit(None).cast("string").alias("value"))
    return spans.groupBy("text_key").agg(F.collect_list(span).alias("added"))


def with_spans(rows: DataFrame, added: DataFrame) -> DataFrame:
    """Rows with ``doc_id, text_key, text`` and their ``spans``, base and added ones by start, then kind."""
    added = checkpointed(added)
    added = bounded(added, added.agg(F.sum(F.size("added"))).first()[0] or 0).withColumnRenamed("text_key", "_key")
    joined = with_base(rows).join(added, F.col("text_key") == F.col("_key"), "left").drop("_key")
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return joined.withColumn("spans", every).drop("added")


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find(documents: DataFrame) -> DataFrame:
    """Spans of every whole text: ``doc_id``, a count per base kind, ``base`` and ``spans`` (kind:start:stop by comma).

    Null and empty texts have none. Repeated rows give a row each; equal texts have equal spans. A null id stays null.
    Base spans of different kinds may overlap; added spans overlap no base span.
    """
    rows = with_spans(rows_of(documents), revealing_spans(documents))
    return rows.select("doc_id", *(f"n_{k}" for k in KINDS), listed("base").alias("base"), listed("spans").alias("spans"))


MASK = """
aggregate(spans, named_struct('at', 0, 'out', CAST(array() AS array<string>)),
  (acc, s) -> CASE WHEN s.start < acc.at THEN named_struct('at', greatest(acc.at, s.stop), 'out', acc.out)
    ELSE named_struct('at', s.stop, 'out', concat(acc.out, array(substring(text, acc.at + 1, s.start - acc.at), placeholders[s.kind]))) END,
  acc -> concat(array_join(acc.out, ''), substring(text, acc.at + 1, length(text))))
"""


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents with all spans replaced by their placeholders (overlapping ones by the first's), other columns kept.

    ``n_chars`` follows the text where there is such a column. Texts without spans, null ones too, stay as they are.
    """
    added = revealing_spans(documents)
    rows = documents.withColumn("_given", F.col("text")).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("text_key", F.xxhash64("text"))
    marks = F.create_map(*(F.lit(x) for pair in PLACEHOLDERS.items() for x in pair))
    rows = with_spans(rows, added).withColumn("placeholders", marks)
    changed = F.size("spans") > 0
    rows = rows.withColumn("_masked", F.when(changed, F.expr(MASK)))
    out = {"text": F.when(changed, F.col("_masked")).otherwise(F.col("_given"))}
    if "n_chars" in documents.columns:
        out["n_chars"] = F.when(changed, F.length("_masked").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.withColumns(out).select(*documents.columns)
