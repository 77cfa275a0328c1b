"""Secret scans by a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is parsed on the driver into a Boolean query over
trigrams: a conjunction of alternatives, each the trigrams of one string that a match
must hold.  The texts are indexed by the trigrams that any query names (folded to lower
case), the postings of a text are intersected by one aggregation, and only texts whose
postings satisfy a rule's query are put to its expression.  A rule without a mandatory
trigram scans every text.

The index is keyed by a hash of the text, so copies share their postings, and neither
null nor repeated doc ids matter; a hash collision adds a candidate and never loses
one.  Candidates are broadcast while their count is within ``BROADCAST_ROWS`` and
joined by shuffle beyond.  Null texts are empty; an empty table stays empty; input columns
keep their values whatever they are called.  Offsets are in code points, the end
exclusive; matches of one kind are leftmost and do not overlap; kinds may overlap.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.llm.common import unused, whole_text, written

BROADCAST_ROWS = 1_000_000
#: Strings that a part of an expression may expand to before it counts as unknown.
EXPANSION = 16
#: Matches of a rule whose places are added up at a time.
RUN = 128
#: Letters of the pieces that a long text is cut to before spans are taken out of it.
PIECE = 4096


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the group whose length must reach ``least``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False

    def java(self) -> str:
        return f"(?i){self.pattern}" if self.ignore_case else self.pattern


#: The base kinds in their order, then the kinds that this method adds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
)
RULES = BASE + ADDED


def _thinned(grams: list[str]) -> frozenset[str]:
    """The first, middle and last trigram of a string: fewer postings, and still necessary."""
    return frozenset({grams[0], grams[len(grams) // 2], grams[-1]})


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """A conjunction of disjunctions of trigram sets that every match satisfies.

    Literals, small classes, optional parts and alternations are expanded to the exact
    strings of a run; whatever cannot be expanded ends the run.  A run yields a
    conjunct if each of its strings has a trigram.
    """
    from re import _constants as op, _parser

    conjuncts: list[list[frozenset[str]]] = []

    def flush(run: set[str]) -> set[str]:
        if run and all(len(s) >= 3 for s in run):
            conjuncts.append([_thinned([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(run)])
        return {""}

    def exact(code, argument) -> set[str] | None:
        """The strings of one element if they are few, else None."""
        if code is op.LITERAL:
            return {chr(argument).lower()}
        if code is op.IN and argument[0][0] is not op.NEGATE:
            found = set()
            for kind, value in argument:
                if kind is op.LITERAL:
                    found.add(chr(value).lower())
                elif kind is op.RANGE and value[1] - value[0] < EXPANSION:
                    found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
                else:
                    return None
            return found if len(found) <= EXPANSION else None
        if code is op.SUBPATTERN:
            return several(argument[3])
        if code is op.BRANCH:
            parts = [several(branch) for branch in argument[1]]
            return None if None in parts else set().union(*parts)
        if code is op.MAX_REPEAT and argument[1] != op.MAXREPEAT and argument[1] <= 2:
            inner = several(argument[2])
            if inner is not None:
                return {"".join(p) for n in range(argument[0], argument[1] + 1) for p in product(inner, repeat=n)}
        return None

    def several(elements) -> set[str] | None:
        run = {""}
        for element in elements:
            found = exact(*element)
            if found is None or len(run) * len(found) > EXPANSION:
                return None
            run = {a + b for a in run for b in found}
        return run

    run = {""}
    for element in _parser.parse(pattern):
        found = exact(*element)
        if found is None:
            run = flush(run)
        elif len(run) * len(found) > EXPANSION:
            flush(run)
            run = found
        else:
            run = {a + b for a in run for b in found}
    flush(run)
    return conjuncts


def _index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """The postings: a row for each text (by hash) and each named trigram that it holds."""
    present = F.filter(F.array(*map(F.lit, grams)), lambda g: F.contains(F.col("_folded"), g))
    texts = docs.select(F.xxhash64("_text").alias("_h"), F.lower("_text").alias("_folded"))
    return texts.select("_h", F.explode(present).alias("gram"))


def _candidates(postings: DataFrame, grams: list[str], queries: dict[str, list]) -> DataFrame:
    """Texts whose intersected postings satisfy at least one rule, with a flag for each rule."""
    place = F.create_map(*[F.lit(x) for k, g in enumerate(grams) for x in (g, 1 << k)])
    held = postings.groupBy("_h").agg(F.bit_or(F.element_at(place, F.col("gram")).cast("long")).alias("_held"))

    def satisfied(query: list) -> Column:
        flag = F.lit(True)
        for alternatives in query:
            one = F.lit(False)
            for strings in alternatives:
                mask = F.lit(sum(1 << grams.index(g) for g in strings)).cast("long")
                one = one | (F.col("_held").bitwiseAND(mask) == mask)
            flag = flag & one
        return flag

    flags = {f"_may_{kind}": satisfied(query) for kind, query in queries.items()}
    some = F.lit(False)
    for flag in flags.values():
        some = some | flag
    return held.where(some).select("_h", *[flag.alias(name) for name, flag in flags.items()])


def _spans(rule: Rule, kind: int, text: Column) -> Column:
    """array<struct<start, kind, end>> of a rule's matches in a text.

    The text is split around the matches; lengths of the gaps and matches, added up in
    order, are the offsets.
    """
    pattern = F.lit(rule.java())
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.java(), -1)
    parts = F.zip_with(
        F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("n"))),
        tested,
        lambda p, t: F.struct(p["gap"].alias("gap"), p["n"].alias("n"), (F.length(t) >= rule.least).alias("kept")),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def add(state, part):
        start = state["at"] + part["gap"]
        end = start + part["n"]
        one = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(part["kept"], F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans"))

    def placed(p: Column) -> Column:
        """Appending copies what is there, so matches are taken RUN at a time: where each run begins, then its spans."""
        cuts = F.transform(F.sequence(F.lit(0), F.greatest(F.size(p) - 1, F.lit(0)), F.lit(RUN)), lambda k: F.slice(p, k + 1, F.lit(RUN)))
        length = F.transform(cuts, lambda c: F.aggregate(c, F.lit(0), lambda x, m: x + m["gap"] + m["n"]))
        begins = F.aggregate(length, F.array(F.lit(0)), lambda x, n: F.concat(x, F.array(F.element_at(x, -1) + n)))
        spans = lambda c, at: F.aggregate(c, F.struct(at.alias("at"), none.alias("spans")), add, lambda state: state["spans"])
        return F.when(F.size(p) <= RUN, spans(p, F.lit(0))).otherwise(F.flatten(F.zip_with(cuts, F.slice(begins, F.lit(1), F.size(cuts)), spans)))

    return _given(parts, placed)


def _given(value: Column, use) -> Column:
    """``use`` of a value that is worked out once: lambdas evaluate what stands in them for every element."""
    return F.transform(F.array(value), use)[0]


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, into: str = "secrets") -> DataFrame:
    """``docs`` with a column ``into``: array<struct<start, kind, end>> by start, then kind.

    ``kind`` is the rule's place in ``rules``.  Every input row comes back once, with
    its own columns as they were (one of that name is replaced).
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    grams = sorted({g for query in queries.values() for alternatives in query for strings in alternatives for g in strings})
    if len(grams) > 62:
        raise ValueError("the rules name more trigrams than one mask holds; scan them in groups")
    indexed = {kind: query for kind, query in queries.items() if query}
    postings = _index(docs.select(whole_text().alias("_text")), grams)
    candidates = written(_candidates(postings, grams, indexed), "secret-candidates")
    text, hashed = unused(docs, "_text"), unused(docs, "_h")
    flags = {kind: unused(docs, f"_may_{kind}") for kind in indexed}
    candidates_ = candidates.select(F.col("_h").alias(hashed), *[F.col(f"_may_{kind}").alias(name) for kind, name in flags.items()])
    if candidates.count() <= BROADCAST_ROWS:
        candidates_ = F.broadcast(candidates_)
    joined = docs.withColumn(text, whole_text()).withColumn(hashed, F.xxhash64(text)).join(candidates_, hashed, "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    kinds = []
    for k, rule in enumerate(rules):
        may = F.coalesce(F.col(flags[rule.kind]), F.lit(False)) if rule.kind in indexed else F.col(text).rlike(rule.java())
        kinds.append(F.when(may, _spans(rule, k, F.col(text))).otherwise(none))
    found = F.array_sort(F.concat(*kinds)).alias(into)
    return joined.select(*[F.col(c) for c in docs.columns if c.lower() != into.lower()], found)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by ``mark``; overlapping spans by one mark."""
    spans = unused(docs, "_secrets")

    def merge(state, span):
        """Spans by their start: one that begins within the last merged one makes it longer."""
        last = F.element_at(state, -1)
        within = (F.size(state) > 0) & (span["start"] < F.coalesce(F.try_element_at(state, F.lit(-1))["end"], F.lit(-1)))
        longer = F.concat(F.slice(state, F.lit(1), F.size(state) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))))
        return F.when(within, longer).otherwise(F.concat(state, F.array(F.struct(span["start"].alias("start"), span["end"].alias("end")))))

    def cleaned(text: Column, found: Column) -> Column:
        """What lies between the spans.  A substring walks from its text's start, so it is taken from a piece near it."""
        def joined(given: Column) -> Column:
            def between(a, z):
                first = F.floor(a / PIECE).cast("int")
                near = F.slice(given["pieces"], first + 1, F.floor(z / PIECE).cast("int") - first + 1)
                return F.substring(F.array_join(near, ""), a - first * PIECE + 1, z - a)

            return F.array_join(F.zip_with(given["ends"], given["starts"], between), mark)

        pieces = F.transform(F.sequence(F.lit(0), F.length(text), F.lit(PIECE)), lambda k: F.substring(text, k + 1, F.lit(PIECE)))
        ends = F.concat(F.array(F.lit(0)), F.transform(found, lambda x: x["end"]))
        starts = F.concat(F.transform(found, lambda x: x["start"]), F.array(F.length(text)))
        return _given(F.struct(pieces.alias("pieces"), ends.alias("ends"), starts.alias("starts")), joined)

    merged = F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), merge)
    found = secret_spans(docs, rules, spans)
    text = F.col("text")
    return found.withColumn("text", F.when(F.size(spans) > 0, _given(merged, lambda m: cleaned(text, m))).otherwise(text)).select(*docs.columns)


def digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans, and all spans as text."""
    names = F.array(*[F.lit(r.kind) for r in rules])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(k: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")

    return secret_spans(docs.select("doc_id", "text"), rules).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[of_kind(k).alias(f"n_{r.kind}") for k, r in enumerate(rules[:base])],
        F.sha2(listed(F.filter("secrets", lambda s: s["kind"] < base)), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def oracle(rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> str:
    """DuckDB SQL of ``digest``: every rule put to every text, no index."""

    def quoted(rule: Rule) -> str:
        return "'" + rule.java().replace("'", "''") + "'"

    def spans(k: int, rule: Rule) -> str:
        total = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
        start = f"{total.format(f'g{k}[1:i]')} + {total.format(f'm{k}[1:i-1]')}"
        each = f"list_transform(range(1, len(m{k}) + 1), lambda i: {{'s': ({start})::BIGINT, 'k': {k}, 'e': ({start} + length(m{k}[i]))::BIGINT, 'n': length(v{k}[i])}})"
        return f"list_filter({each}, lambda y: y.n >= {rule.least})"

    matches = ", ".join(f"regexp_extract_all(t, {quoted(r)}, 0) m{k}, regexp_extract_all(t, {quoted(r)}, {r.group}) v{k}, regexp_split_to_array(t, {quoted(r)}) g{k}" for k, r in enumerate(rules))
    found = ", ".join(f"{spans(k, r)} s{k}" for k, r in enumerate(rules))
    kind = " ".join(f"when {k} then '{r.kind}'" for k, r in enumerate(rules))

    def listed(n: int) -> str:
        both = "list_concat(" * (n - 1) + "s0" + "".join(f", s{k})" for k in range(1, n))
        return f"array_to_string(list_transform(list_sort({both}), lambda y: (case y.k {kind} end) || ':' || y.s || ':' || y.e), ',')"

    counts = ", ".join(f"len(s{k})::BIGINT n_{r.kind}" for k, r in enumerate(rules[:base]))
    return (
        f"with a as (select doc_id, coalesce(text, '') t from documents), b as (select doc_id, {matches} from a), c as (select doc_id, {found} from b) "
        f"select doc_id, {counts}, sha256({listed(base)}) base_sha256, {listed(len(rules))} spans from c"
    )
