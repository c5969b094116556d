"""Faceted full-text search: lexemes, web-search queries, matching, rank, filters, paging.

A query text is parsed on the driver into a small tree; the tree becomes Column expressions over two
arrays of lexemes (title and skills weigh more than employer and categories).  Matching and ranking
run inside the scan; no index is needed, and the optimiser sees plain predicates.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.functions.text import TECHNOLOGY_NAMES, fold_tables, once, search_form
from listweave.vocabulary import EXPERIENCE_BUCKETS, SENIORITY, WORK_MODES

# Weights of title/skills and of employer/categories, and the sum of 1/n^2.
WEIGHT_A, WEIGHT_B, ZETA_2 = 1.0, 0.4, 1.64493406685
MAX_POSITIONS = 16383
#: A word with hyphens counts as a whole and by its parts.
_WORDS = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"


class InvalidFilter(ValueError):
    """A search parameter is out of range."""


# -- lexemes ---------------------------------------------------------------------------------------


def lexemes(text: Column, form: Callable[[Column], Column] = search_form) -> Column:
    """Words of a text's ``form`` in order; a hyphenated word is followed by its parts."""
    words = F.regexp_extract_all(form(text), F.lit(f"({_WORDS})"), 1)
    return F.flatten(F.transform(words, lambda w: F.when(F.contains(w, F.lit("-")), F.concat(F.array(w), F.split(w, "-"))).otherwise(F.array(w))))


def _joined_texts() -> tuple[Column, Column]:
    joined = lambda head, tail: F.concat(F.coalesce(F.col(head), F.lit("")), F.lit(" "), F.coalesce(F.array_join(tail, " "), F.lit("")))
    return joined("title", "skills_raw"), joined("employer_name_raw", "categories_raw")


def with_lexemes(jobs: DataFrame) -> DataFrame:
    """``jobs`` with lex_a (title, skills) and lex_b (employer, categories)."""
    a, b = _joined_texts()
    return jobs.withColumns({"lex_a": lexemes(a), "lex_b": lexemes(b)})


def with_lexemes_of(jobs: DataFrame, form: Callable[[Column], Column]) -> DataFrame:
    """``with_lexemes`` in another normal form; the generator makes each row's lexemes one time."""
    a, b = _joined_texts()
    return jobs.select("*", F.inline(F.array(F.struct(lexemes(a, form).alias("lex_a"), lexemes(b, form).alias("lex_b")))))


def python_search_form(text: str) -> str:
    """``search_form`` for the driver."""
    source, target = fold_tables()
    out = text.translate(str.maketrans(source, target))
    for letter, plain in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE")):
        out = out.replace(letter, plain)
    out = out.lower()
    for pattern, word in TECHNOLOGY_NAMES:
        out = re.sub(pattern, lambda m, w=word: (m[1] or "") + w, out)
    return out


def python_lexemes(text: str, parts_only: bool = False) -> list[str]:
    """Lexemes of already normalised text; ``parts_only`` leaves whole hyphenated words out."""
    out = []
    for word in re.findall(r"[^\W_]+(?:-[^\W_]+)*", text):
        pieces = word.split("-")
        out += pieces if parts_only and len(pieces) > 1 else [word, *pieces] if len(pieces) > 1 else [word]
    return out


# -- query trees -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Term:
    lexeme: str
    prefix: bool = False


@dataclass(frozen=True)
class Phrase:
    lexemes: tuple[str, ...]


@dataclass(frozen=True)
class Not:
    node: object


@dataclass(frozen=True)
class And:
    nodes: tuple


@dataclass(frozen=True)
class Or:
    nodes: tuple


def _join(kind, nodes):
    nodes = tuple(n for n in nodes if n is not None)
    return None if not nodes else nodes[0] if len(nodes) == 1 else kind(nodes)


def _operand(text: str):
    """A bare word as the phrase of its lexemes (hyphenated words hold several)."""
    found = python_lexemes(text)
    return None if not found else Term(found[0]) if len(found) == 1 else Phrase(tuple(found))


def parse_web_query(normalised: str):
    """Tree of a query in web-search style: quotes for phrases, ``or``, a leading minus for exclusion.

    Everything else is joined by and; punctuation is ignored; None if no lexeme is left.
    """
    groups: list[list] = [[]]
    for minus, quoted, word in re.findall(r'(-?)"([^"]*)"?|(\S+)', normalised):
        if word:
            if word == "or" and groups[-1]:
                groups.append([])
                continue
            minus, body = ("-", word[1:]) if word.startswith("-") else ("", word)
            # a quote inside a word begins a phrase
            nodes = [_operand(b) for b in body.split('"') if b]
        else:
            found = python_lexemes(quoted)
            nodes = [Term(found[0]) if len(found) == 1 else Phrase(tuple(found))] if found else []
        node = _join(And, nodes)
        if node is not None:
            groups[-1].append(Not(node) if minus else node)
    return _join(Or, [_join(And, g) for g in groups])


def parse_query(text: str | None, prefix: bool = True):
    """(has text, tree): the last word also matches as a prefix if it has three letters or more and the
    query uses no quotes, no ``or`` and no exclusion."""
    if not (text or "").strip():
        return False, None
    normalised = python_search_form(text).rstrip()
    tree = parse_web_query(normalised)
    if tree is None or not prefix:
        return True, tree
    special = '"' in normalised or re.search(r"(^|[^\w-])or($|[^\w-])", normalised) or re.search(r"(^|[^\w])-", normalised)
    if special:
        return True, tree
    tail = re.search(r"\S+$", normalised)[0]
    words = python_lexemes(tail, parts_only=True)
    if not words or len(words[-1]) < 3:
        return True, tree
    head = parse_web_query(normalised[: len(normalised) - len(tail)])
    last = [Term(w, prefix=i == len(words) - 1) for i, w in enumerate(words)]
    flat = list(head.nodes) if isinstance(head, And) else [] if head is None else [head]
    return True, _join(And, flat + last)


# -- matching and rank -----------------------------------------------------------------------------


def _all() -> Column:
    return F.concat("lex_a", "lex_b")


def _term_hit(t: Term, lex: Column) -> Column:
    return F.exists(lex, lambda x: F.startswith(x, F.lit(t.lexeme))) if t.prefix else F.array_contains(lex, t.lexeme)


def _phrase_hit(p: Phrase, lex: Column) -> Column:
    # lexemes hold no line ends, so neighbours in the array are neighbours in the joined text
    return F.contains(F.concat(F.lit("\n"), F.array_join(lex, "\n"), F.lit("\n")), F.lit("\n" + "\n".join(p.lexemes) + "\n"))


def matches(node) -> Column:
    """Predicate of a tree over lex_a and lex_b."""
    if isinstance(node, Term):
        return _term_hit(node, F.col("lex_a")) | _term_hit(node, F.col("lex_b"))
    if isinstance(node, Phrase):
        return _phrase_hit(node, _all())
    if isinstance(node, Not):
        return ~matches(node.node)
    parts = [matches(n) for n in node.nodes]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if isinstance(node, And) else out | p
    return out


def _operands(node) -> list[Term]:
    """Distinct lexemes of a tree, those under a negation as well, in order."""
    if isinstance(node, Term):
        return [node]
    if isinstance(node, Phrase):
        return [Term(x) for x in node.lexemes]
    if isinstance(node, Not):
        return _operands(node.node)
    return [t for n in node.nodes for t in _operands(n)]


def _hits(t: Term, positions: int | None) -> Column:
    """(position, weight) of a term in both arrays, positions running on from one to the other; those past
    ``positions``, if given, count as that one."""
    def of(name: str, weight: float, shift: Column) -> Column:
        at = F.transform(name, lambda x, i: F.struct((i + 1 + shift).cast("int").alias("p"), F.lit(weight).alias("w"), x.alias("x")))
        return F.filter(at, lambda s: F.startswith(s["x"], F.lit(t.lexeme)) if t.prefix else s["x"] == t.lexeme)

    both = F.concat(of("lex_a", WEIGHT_A, F.lit(0)), of("lex_b", WEIGHT_B, F.size("lex_a")))
    return F.transform(both, lambda s: F.struct((F.least(s["p"], F.lit(positions)) if positions else s["p"]).alias("p"), s["w"].alias("w")))


def _rank_single(hits: Column) -> Column:
    """Share of one operand: its weights damped by the square of their order, the largest undamped."""
    damped = F.aggregate(F.transform(hits, lambda s, j: s["w"] / ((j + 1) * (j + 1)).cast("double")), F.lit(0.0), lambda a, x: a + x)
    top = F.array_max(F.transform(hits, lambda s: s["w"]))
    first = F.array_position(F.transform(hits, lambda s: s["w"]), top).cast("double")
    return F.when(F.size(hits) > 0, (top + damped - top / (first * first)) / ZETA_2).otherwise(0.0)


def _rank_pairs(all_hits: list[Column]) -> Column:
    """Nearness of the operands: each pair of places counts by weight and distance, joined as
    independent chances."""
    def miss(a: Column, b: Column) -> Column:
        d = F.abs(a["p"] - b["p"])
        chance = F.sqrt(a["w"] * b["w"] * F.when(d > 100, 1e-30).otherwise(F.lit(1.0) / (F.lit(1.005) + F.lit(0.05) * F.exp(d / 1.5 - 2))))
        return F.when(d > 0, 1 - chance).otherwise(1.0)

    def missed(hits: Column) -> Column:
        # pairs are counted as they are met: an array of them would have the product of both lengths
        out = F.lit(1.0)
        for i in range(len(all_hits)):
            for k in range(i):
                other = F.get(hits, F.lit(k))
                out = F.aggregate(F.get(hits, F.lit(i)), out, lambda r, a: F.aggregate(other, r, lambda q, b: q * miss(a, b)))
        return out

    return once(once(F.array(*all_hits), missed), lambda m: F.when(m == 1, 1e-20).otherwise(1 - m))


def score(node, positions: int | None = None) -> Column:
    """Score of a row for the tree; positions past ``positions`` count as that one, by default all count."""
    terms = list(dict.fromkeys(_operands(node)))
    hits = [_hits(t, positions) for t in terms]
    if isinstance(node, And | Phrase) and len(terms) > 1:
        return _rank_pairs(hits)
    return sum((_rank_single(h) for h in hits), F.lit(0.0)) / len(terms)


def rank(node) -> Column:
    """``score`` as a float, with the bound on positions of a search index."""
    return score(node, MAX_POSITIONS).cast("float")


# -- parameters ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Filters:
    """Parameters of search and statistics; checked when made."""

    query: str = ""
    sources: Sequence[str] = ()
    cities: Sequence[str] = ()
    experience: str = ""
    seniority: Sequence[str] = ()
    modes: Sequence[str] = ()
    days: int = 0
    skills: Sequence[str] = ()
    skill_match: str = "any"
    skill_scope: str = "required"
    known_skills: frozenset[str] | None = field(default=None, compare=False)

    def __post_init__(self):
        ok = (
            len(self.query or "") <= 200
            and self.days in (0, 1, 7, 30)
            and self.experience in ("", *EXPERIENCE_BUCKETS)
            and None not in (self.sources, self.cities, self.seniority, self.modes, self.skills)
            and len(self.sources) <= 20 and len(self.cities) <= 20 and len(self.seniority) <= 9 and len(self.modes) <= 4 and len(self.skills) <= 10
            and all(isinstance(s, str) and re.fullmatch(r"[a-z0-9_-]{1,50}", s) for s in self.sources)
            and all(isinstance(c, str) and 1 <= len(c) <= 120 and not re.search(r"[\x00-\x1f\x7f]", c) for c in self.cities)
            and all(s in (*SENIORITY, "unknown") for s in self.seniority)
            and all(m in (*WORK_MODES, "unknown") for m in self.modes)
            and self.skill_match in ("any", "all") and self.skill_scope in ("required", "all")
            and all(self.known_skills is None or k in self.known_skills for k in self.skills)
        )
        if not ok:
            raise InvalidFilter("Invalid search filters")


@dataclass(frozen=True)
class Page:
    sort: str = "relevance"
    limit: int = 20
    offset: int = 0

    def __post_init__(self):
        if self.sort not in ("relevance", "newest") or not 1 <= self.limit <= 100 or not 0 <= self.offset <= 10_000:
            raise InvalidFilter("Invalid search pagination")


def gated(jobs: DataFrame) -> DataFrame:
    """``jobs`` with exp, levels and mode: enriched values, only where enrichment succeeded and they are sane."""
    done = F.col("enrichment_status") == "succeeded"
    low, high = F.col("experience_min_years"), F.col("experience_max_years")
    levels = F.filter(F.coalesce("seniority_levels", F.array().cast("array<string>")), lambda x: x.isin(*SENIORITY))
    return jobs.withColumns({
        "exp": F.when(done & low.between(0, 60) & (high.isNull() | high.between(low, 60)), low),
        "levels": F.when(done, levels).otherwise(F.array().cast("array<string>")),
        "mode": F.when(done & F.col("work_mode").isin(*WORK_MODES), F.col("work_mode")),
    })


def experience_bucket(exp: Column) -> Column:
    return F.when(exp.isNull(), "unknown").when(exp == 0, "zero").when(exp < 1, "under1").when(exp < 3, "1to3").when(exp < 5, "3to5").otherwise("5plus")


def effective_date() -> Column:
    return F.coalesce("posted_at", "first_seen_at")


def skill_keys(scope: str) -> Column:
    return F.concat("required_skill_keys", "preferred_skill_keys") if scope == "all" else F.col("required_skill_keys")


def matching(jobs: DataFrame, f: Filters, as_of: datetime, prefix: bool = True) -> tuple[DataFrame, object]:
    """(rows of ``jobs`` that pass all filters, with exp, levels and mode; query tree).

    ``jobs`` has source_code and lexemes.  Options within a filter are alternatives; filters add up;
    an empty filter is none.  A query of punctuation only matches nothing.
    """
    asked, tree = parse_query(f.query, prefix)
    x = gated(jobs)
    if asked:
        x = x.where(matches(tree) if tree is not None else F.lit(False))
    if f.sources:
        x = x.where(F.col("source_code").isin(*f.sources))
    if f.cities:
        x = x.where(F.arrays_overlap("location_cities", F.array(*[F.lit(c) for c in f.cities])))
    if f.experience:
        x = x.where(experience_bucket(F.col("exp")) == f.experience)
    if f.seniority:
        named = F.arrays_overlap("levels", F.array(*[F.lit(s) for s in f.seniority]))
        x = x.where(named | (F.size("levels") == 0) if "unknown" in f.seniority else named)
    if f.modes:
        named = F.coalesce(F.col("mode").isin(*f.modes), F.lit(False))
        x = x.where(named | F.col("mode").isNull() if "unknown" in f.modes else named)
    if f.days:
        at = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
        x = x.where(effective_date().between(at - F.make_dt_interval(F.lit(f.days)), at))
    if f.skills:
        wanted = F.array(*[F.lit(k) for k in f.skills])
        keys = skill_keys(f.skill_scope)
        x = x.where(F.size(F.array_except(wanted, keys)) == 0 if f.skill_match == "all" else F.arrays_overlap(keys, wanted))
    return x, tree


def search(jobs: DataFrame, f: Filters, page: Page, as_of: datetime, prefix: bool = True) -> DataFrame:
    """One page of matching rows with score: by score (or not), then date, then id, all descending."""
    found, tree = matching(jobs, f, as_of, prefix)
    scored = found.withColumn("score", rank(tree) if tree is not None else F.lit(0.0).cast("float"))
    order = [F.desc("score")] if page.sort == "relevance" else []
    order += [effective_date().desc_nulls_last(), F.desc("id")]
    return scored.orderBy(*order).offset(page.offset).limit(page.limit)


def search_simple(jobs: DataFrame, query: str = "", source: str | None = None, city: str | None = None, limit: int = 20, offset: int = 0, prefix: bool = True, as_of: datetime | None = None) -> DataFrame:
    """The first contract of search: one source and one city at most, newest by posting date."""
    found, tree = matching(jobs, Filters(query=query, sources=[source] if source else [], cities=[city] if city else []), as_of or datetime(2000, 1, 1), prefix)
    page = Page(limit=limit, offset=offset)
    scored = found.withColumn("score", rank(tree) if tree is not None else F.lit(0.0).cast("float"))
    return scored.orderBy(F.desc("score"), F.desc_nulls_last("posted_at"), F.desc("id")).offset(page.offset).limit(page.limit)
