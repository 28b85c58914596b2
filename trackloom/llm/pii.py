"""Personal data: four kinds by pattern, and the words around them that give them away.

Base kinds are the leftmost non-overlapping matches of each pattern, less those that fail the kind's test. Candidate terms of a
protected value are all letter runs of the documents that hold it, wherever they stand, unless a base span overlaps them. Over the
whole corpus, documents are counted per protected value, per term and per pair; the pointwise mutual information of a pair, over
the information content of the value, says what share of the value a term discloses. Terms at or above `generalise` give way to a
general word, those at or above `remove` to nothing, at every place in the documents that hold the value; both are reported
as spans of kind `term`. A pair counts only from `support` documents on, so what stood with a value once is left alone, as is
everything in documents without personal data.

Values and terms of fewer than `support` documents have no pair that counts, and a term of more than N (n / N) ** generalise of
all N documents cannot disclose a value of n of them: even in all its n documents its share would be too low. Such pairs are
not made; no result is lost.

Only DataFrame functions are used. Positions come from splitting a text at its matches: the lengths of the pieces between and of
the matches add up to them. Patterns are written so that they take linear time and no recursion on any text.

Cases: a null text is the empty text. A document without a match has no spans and the hash of the empty string. Rows that
repeat are separate documents. Positions count code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trackloom.llm.common import settle

#: In order of the kinds: name and Java pattern. They find what the plain patterns find, without retries inside a run.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts that cannot match are spared the pattern.
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
#: Letters of the shortest term that `report` and `sanitise` judge, and that `find_personal_data` judges by default.
SHORTEST, SHORTEST_BY_DEFAULT = 1, 4
#: Takes the place of letters within base spans; texts have it as a blank. It is no character and no letter.
MASK = "\ufdd0"
#: No longer used here: terms are taken from whole documents. The plain counts of the tests read it.
CONTEXT = 48
SUPPORT = 2
GENERALISE, REMOVE = 0.9, 0.99
GENERAL = "[word]"

#: Matches or marks that are walked over with one growing list. Lists of blocks are joined.
BLOCK = 64

SPAN = "struct<start: int, end: int, value: string>"


def sql_text(pattern: str) -> str:
    return "r'" + pattern + "'"


def located(text: str, pattern: str, gate: str | None = None, wanted: str = "true") -> str:
    """SQL: every match in a text with start, end and value, if the SQL condition `wanted` holds for its value `p.hits[i]`."""
    hits = f"regexp_extract_all({text}, {sql_text(pattern)}, 0)"
    pieces = f"named_struct('gaps', split({text}, {sql_text(pattern)}, -1), 'hits', {hits})"
    step = f"""(a, i) -> named_struct(
        'at', a.at + length(p.gaps[i]) + length(p.hits[i]),
        'found', case when {wanted} then array_append(a.found, named_struct(
            'start', a.at + length(p.gaps[i]), 'end', a.at + length(p.gaps[i]) + length(p.hits[i]), 'value', p.hits[i])) else a.found end)"""
    lengths = "transform(p.hits, (h, i) -> length(p.gaps[i]) + length(h))"
    blocks = f"sequence(0, (size(p.hits) - 1) div {BLOCK})"
    # where each block of matches starts, so that lists only grow within a block
    starts = f"""transform(array({lengths}), n -> aggregate({blocks}, named_struct('at', 0, 'starts', cast(array() as array<int>)),
        (a, b) -> named_struct('at', a.at + aggregate(slice(n, int(b * {BLOCK} + 1), {BLOCK}), 0, (s, x) -> s + x), 'starts', array_append(a.starts, a.at)),
        a -> a.starts))[0]"""
    start = f"named_struct('at', at, 'found', cast(array() as array<{SPAN}>))"
    own = f"sequence(int(b) * {BLOCK}, least(size(p.hits), int(b + 1) * {BLOCK}) - 1)"
    walk = f"transform(array({pieces}), p -> flatten(transform({starts}, (at, b) -> aggregate({own}, {start}, {step}, a -> a.found))))[0]"
    none = f"cast(array() as array<{SPAN}>)"
    return f"case when {text} rlike {sql_text(gate or pattern)} then case when {text} rlike {sql_text(pattern)} then {walk} else {none} end else {none} end"


DIGITS = "regexp_replace(s.value, '[^0-9]', '')"
LUHN = f"""aggregate(sequence(1, length({DIGITS})), 0, (a, i) -> a + case
    when i % 2 = 1 then cast(substring({DIGITS}, -i, 1) as int)
    when cast(substring({DIGITS}, -i, 1) as int) > 4 then 2 * cast(substring({DIGITS}, -i, 1) as int) - 9
    else 2 * cast(substring({DIGITS}, -i, 1) as int) end) % 10 = 0"""
TESTS = {
    "email": "true",
    "ip": "forall(split(s.value, '[.]'), x -> coalesce(try_cast(x as int) <= 255, false))",
    "card": f"case when length({DIGITS}) between 16 and 19 then {LUHN} else false end",
    "phone": f"length({DIGITS}) between 8 and 15",
}


def base_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds a column per kind with its accepted matches, and `spans` with all: kind, start, end, value."""
    raw = docs.withColumn("text_", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    raw = raw.withColumns({f"{k}_": F.expr(located("text_", p, GATES[k])) for k, p in KINDS.items()}).drop("text_")
    tested = raw.withColumns({f"{k}_": F.expr(f"filter({k}_, s -> {t})") for k, t in TESTS.items()})
    named = [f"transform({k}_, s -> named_struct('kind', '{k}', 'start', s.start, 'end', s.end, 'value', lower(s.value)))" for k in KINDS]
    return tested.withColumn("spans", F.expr(f"concat({', '.join(named)})"))


def masked(text: str) -> str:
    """SQL: the text, place by place, with the letters of its base spans masked. Only addresses hold letters, and all are accepted."""
    letters = "".join(chr(c) for c in (*range(65, 91), *range(97, 123)))
    plain, pattern = f"translate({text}, '{MASK}', ' ')", sql_text(KINDS["email"])
    pieces = f"named_struct('gaps', split({plain}, {pattern}, -1), 'hits', regexp_extract_all({plain}, {pattern}, 0))"
    put = f"concat(g, coalesce(translate(get(p.hits, i), '{letters}', '{MASK * len(letters)}'), ''))"
    return f"case when {text} rlike '@' then transform(array({pieces}), p -> array_join(transform(p.gaps, (g, i) -> {put}), ''))[0] else {plain} end"


def words(shortest: int) -> str:
    """Pattern of letter runs."""
    return rf"(?<!\p{{L}})\p{{L}}{{{shortest},}}+"


def free_words(shortest: int) -> str:
    """Pattern of letter runs of a masked text that no base span overlaps."""
    return rf"(?<![\p{{L}}{MASK}])\p{{L}}{{{shortest},}}+(?!{MASK})"


def distinct_words(text: str, pattern: str) -> str:
    return f"array_distinct(transform(regexp_extract_all({text}, {sql_text(pattern)}, 0), w -> lower(w)))"


def possible_pairs(docs: DataFrame, text_col: str, found: DataFrame, total: int, shortest: int, support: int, generalise: float) -> DataFrame:
    """(row, entity, term, n_value, n_term): each term of each document with each value that it holds, where the counts allow a result."""
    holding = found.where("size(spans) > 0")
    held = holding.select("row", F.explode(F.expr("array_distinct(transform(spans, s -> concat(s.kind, ':', s.value)))")).alias("entity"))
    values = held.groupBy(F.col("entity").alias("of")).agg(F.count("*").alias("n_value")).where((F.col("n_value") >= support) & (F.col("n_value") < total))
    held = held.join(values, F.col("entity") == F.col("of")).select("row", "entity", "n_value")
    every = docs.select(F.explode(F.expr(distinct_words(f"cast(`{text_col}` as string)", words(shortest)))).alias("word"))
    frequency = every.groupBy("word").agg(F.count("*").alias("n_term")).where(F.col("n_term") >= support)
    terms = holding.join(held.select("row").distinct(), "row", "left_semi").select("row", F.explode(F.expr(distinct_words("masked", free_words(shortest)))).alias("term"))
    terms = terms.join(frequency, F.col("term") == F.col("word")).select("row", "term", "n_term")
    most = F.lit(float(total)) * F.pow(F.col("n_value") / F.lit(float(total)), F.lit(generalise)) * F.lit(1 + 1e-9)
    return terms.join(held, "row").where(F.col("n_term") <= most).select("row", "entity", "term", "n_value", "n_term")


def disclosed(pairs: DataFrame, total: int, support: int, generalise: float, remove: float) -> DataFrame:
    """(entity, term, action) of the pairs that disclose too much. Every count is over all documents."""
    counts = F.count("*").alias("joint"), F.first("n_value").alias("n_value"), F.first("n_term").alias("n_term")
    known = pairs.groupBy("entity", "term").agg(*counts).where(F.col("joint") >= support)
    everything = F.lit(float(total))
    shared = F.log2(F.col("joint") * everything / (F.col("n_value") * F.col("n_term")))
    content = F.log2(everything / F.col("n_value"))
    told = known.withColumn("share", shared / content).where(F.col("share") >= generalise)
    return told.select("entity", "term", F.when(F.col("share") >= remove, 2).otherwise(1).alias("action"))


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    support: int = SUPPORT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
    shortest: int = SHORTEST_BY_DEFAULT,
) -> DataFrame:
    """One row per document: id, `found_spans` (kind, start, end, value), `found_terms` (start, end, action), columns of `keep`.

    Letter runs of fewer than `shortest` letters are no terms. The texts are read twice: for the matches, which are settled with the
    masked texts of documents that hold any, and for the word counts.
    """
    kept = [F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep or [])]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *kept)
    marked = base_spans(rows, "text").withColumn("row", F.monotonically_increasing_id())
    marked = marked.withColumn("masked", F.when(F.size("spans") > 0, F.expr(masked("cast(text as string)"))))
    found = settle(marked.select("row", "id", "spans", "masked", *[f"keep_{k}" for k in range(len(kept))]), "personal-data")
    total = found.count()
    pairs = settle(possible_pairs(rows, "text", found, total, shortest, support, generalise), "personal-terms")
    told = disclosed(pairs, total, support, generalise, remove)
    actions = pairs.join(told, ["entity", "term"]).groupBy("row", "term").agg(F.max("action").alias("action"))
    actions = actions.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("actions"))
    # the word that the step stands at, by the names that `located` gives
    places = located("masked", free_words(shortest), wanted="map_contains_key(actions, lower(p.hits[i]))")
    places = f"transform({places}, t -> named_struct('start', t.start, 'end', t.end, 'action', actions[lower(t.value)]))"
    none = "cast(array() as array<struct<start: int, end: int, action: int>>)"
    out = found.join(actions, "row", "left").withColumn("terms", F.expr(f"case when actions is null then {none} else {places} end"))
    slim = F.expr("transform(spans, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'value', s.value))")
    names = [F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep or []) if c != id_col]
    return out.select(F.col("id").alias(id_col), slim.alias("found_spans"), F.col("terms").alias("found_terms"), *names)


def listed(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per kind, the hash of the base spans and all spans, per document."""
    found = find_personal_data(docs, id_col, text_col, shortest=SHORTEST)
    counts = {f"n_{k}": F.expr(f"cast(size(filter(found_spans, s -> s.kind = '{k}')) as bigint)") for k in KINDS}
    terms = "transform(found_terms, t -> named_struct('kind', 'term', 'start', t.start, 'end', t.end))"
    base = "transform(found_spans, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end))"
    return found.select(
        id_col,
        *[c.alias(n) for n, c in counts.items()],
        F.sha2(F.expr(listed(base)).cast("binary"), 256).alias("base_sha256"),
        F.expr(listed(f"concat({base}, {terms})")).alias("spans"),
    )


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each base span replaced by its kind in brackets, and disclosing terms generalised or removed."""
    names = list(docs.columns)
    found = find_personal_data(docs, id_col, text_col, keep=[c for c in names if c != id_col], shortest=SHORTEST)
    marks = f"""array_sort(concat(
        transform(found_spans, s -> named_struct('start', s.start, 'end', s.end, 'put', concat('[', s.kind, ']'))),
        transform(found_terms, t -> named_struct('start', t.start, 'end', t.end, 'put', case when t.action = 2 then '' else '{GENERAL}' end))))"""
    text = f"cast(`{text_col}` as string)"
    # a block of marks at a time: its own stretch of the text is taken out first, and the marks' pieces from that
    piece = "substring(part, a.at - done.at + 1, m.start - a.at)"
    walk = f"""aggregate(own, named_struct('at', done.at, 'out', ''), (a, m) -> case
        when m.start >= a.at then named_struct('at', m.end, 'out', concat(a.out, {piece}, m.put))
        else named_struct('at', greatest(a.at, m.end), 'out', a.out) end)"""
    stretch = f"substring({text}, done.at + 1, array_max(transform(own, m -> m.end)) - done.at)"
    block = f"transform(array({stretch}), part -> {walk})[0]"
    build = f"""transform(array({marks}), marks -> aggregate(
        transform(sequence(0, (size(marks) - 1) div {BLOCK}), b -> slice(marks, int(b * {BLOCK} + 1), {BLOCK})),
        named_struct('at', 0, 'out', cast(array() as array<string>)),
        (done, own) -> transform(array({block}), x -> named_struct('at', x.at, 'out', array_append(done.out, x.out)))[0],
        done -> concat(array_join(done.out, ''), substring({text}, done.at + 1, length({text})))))[0]"""
    clean = F.when(F.expr("size(found_spans) + size(found_terms) > 0"), F.expr(build)).otherwise(F.col(text_col))
    return found.withColumn(text_col, clean).select(*[F.col(f"`{c}`").cast(docs.schema[c].dataType) for c in names])

