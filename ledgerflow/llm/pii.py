"""Personal data by weak supervision (DataFrame and SQL functions only).

*Candidates.* Four base kinds - email, ip, card, phone - are found by fixed patterns and
always stay. One more pattern proposes national phone numbers, IBANs, social security
numbers, secrets in assignments and names after a title or with a common given name.

*Labelers.* Four labelers vote yes (1), no (-1) or abstain (0) on every candidate: a strict
format, a gazetteer (top-level domains, issuers, dialling codes, countries, given names,
private networks), the words before it, and what touches its ends.

*Aggregation.* Votes are counted over the whole corpus per (kind, votes) - a bounded table -
and expectation-maximisation estimates each labeler's reliability and each kind's share of
true spans. The posteriors then train the final span classifier, a logistic model on kind,
votes, length and digit share, over the counts of its (bounded) feature combinations. A
proposed span stays when the classifier gives it 0.5 or more and no base span overlaps it.

Matching, positions, votes and decisions are expressions on each document's own row: the
text is never shuffled and no Python runs on the executors. Patterns start only where a run
of their characters begins and use possessive repeats, so a long run is read once.

Offsets count code points, ends are exclusive. Defined results: NULL counts as empty; a
text without candidates has counts 0 and an empty ``spans``; rows that repeat an id are
returned each; without candidates anywhere nothing is proposed; an empty table gives an
empty result; :func:`redact` keeps all columns and replaces ``text`` (NULL stays NULL) and,
where there is one, ``n_chars``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import materialize

# fixed values: the base patterns. Each is equal to its plain form, leftmost and without
# overlap, but enters a run of its characters only at the run's start (or where the last
# match ended) and never gives characters back
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+      whole runs of 16 to 19 digits
#   phone \+[0-9][\x20().0-9-]+[0-9]
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# fixed values: word lists of the gazetteer and context labelers and of the proposals
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Madame Monsieur".split()
GIVEN = ("Alice Andrew Anna Anne Carlos Charles Christine Claire Daniel David Elena Elizabeth Emma Hans Isabel Jack "
         "James Jean Jennifer John José Julia Karl Laura Lucas Luis Maria Marie Mark Mary Michael Nicolas Oliver Pablo "
         "Paul Peter Pierre Robert Sarah Sofia Sophie Stefan Susan Thomas William Wolfgang").split()
DOMAINS = "com org net edu gov io info biz eu de fr es uk us it nl ch at be pt pl se ca au jp in br".split()
DIALLING = "1 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 60 61 62 63 64 65 66 81 82 86 90 91".split()
IBAN = "AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT SE".split()
ASKED = ("call phone tel telephone fax mobile contact mail email write reach card visa mastercard pay iban account bank "
         "ssn social security server host address login key token password from by telefon anruf téléphone correo").split()
COUNTED = "version release order invoice item page chapter section figure isbn id no number vol".split()

PROPOSED = (
    r"(?<![\p{L}\p{N}+])(?:"
    r"\([0-9]{3}\)\x20?[0-9]{3}[-.\x20][0-9]{4}(?![0-9])|[0-9]{3}[-.\x20][0-9]{3}[-.\x20][0-9]{4}(?![0-9])"
    r"|[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
    r"|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
    r"|(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)\x20{0,3}[:=]\x20{0,3}[\"']?[A-Za-z0-9+/_=.-]{12,}+[\"']?"
    r"|(?:" + "|".join(TITLES) + r")\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?"
    r"|(?:" + "|".join(GIVEN) + r")\x20\p{Lu}\p{Ll}++"
    r")"
)
KINDS = (*BASE, "iban", "name", "secret", "ssn")
LABELERS = ("v_format", "v_gazetteer", "v_context", "v_ends")
CONTEXT = 48  # characters before a candidate that the context labeler reads
ROUNDS = 60

BLOCK = 64  # items that a fold gathers at once
CHUNK = 512  # characters that a text is cut into before it is put together again

_SPAN = "struct<s: int, e: int, t: string, before: string, after: string>"


def _q(pattern: str) -> str:
    """A SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _folded(size: str, start: str, kind: str, step: str) -> str:
    """SQL: a fold over the places 0 to ``size`` - 1 that carries a value and puts out items.

    ``step`` turns the state ``a`` (``c`` carried, ``out`` items of this block) and place
    ``i`` into the next state. Items are gathered in blocks, as an append copies its array:
    the cost grows with the places, not with their square. Gives (c, out)."""
    none = f"cast(array() as array<{kind}>)"
    block = f"""aggregate(sequence(k * {BLOCK}, least({size}, (k + 1) * {BLOCK}) - 1),
        named_struct('c', b.c, 'out', {none}), (a, i) -> {step})"""
    return f"""aggregate(sequence(0, shiftright({size} - 1, {BLOCK.bit_length() - 1})),
        named_struct('c', {start}, 'out', cast(array() as array<array<{kind}>>)),
        (b, k) -> transform(array({block}), r -> named_struct('c', r.c, 'out', array_append(b.out, r.out)))[0],
        b -> named_struct('c', b.c, 'out', flatten(b.out)))"""


def _located(name: str) -> Column:
    """The hits of one pattern with places and surroundings, from the matches ``h_name``
    and the texts around them ``p_name``."""
    step = f"""named_struct(
              'c', a.c + length(p_{name}[i]) + length(h_{name}[i]),
              'out', array_append(a.out, named_struct(
                's', a.c + length(p_{name}[i]),
                'e', a.c + length(p_{name}[i]) + length(h_{name}[i]),
                't', h_{name}[i],
                'before', right(p_{name}[i], {CONTEXT}),
                'after', left(p_{name}[i + 1], 1))))"""
    return F.expr(f"""if(size(h_{name}) = 0, cast(array() as array<{_SPAN}>),
        {_folded(f'size(h_{name})', '0', _SPAN, step)}.out)""")


def _meets(spans: str) -> str:
    """SQL condition: ``x`` overlaps one of the sorted ``spans``, which do not overlap each
    other - the last of those that start before its end, found by halving."""
    return f"""(size({spans}) > 0 and aggregate(sequence(1, length(bin(size({spans})))),
        named_struct('lo', 0, 'hi', size({spans})),
        (a, n) -> if(a.lo >= a.hi, a, if({spans}[shiftright(a.lo + a.hi, 1)].s < x.e,
          named_struct('lo', shiftright(a.lo + a.hi, 1) + 1, 'hi', a.hi),
          named_struct('lo', a.lo, 'hi', shiftright(a.lo + a.hi, 1)))),
        a -> if(a.lo > 0, {spans}[a.lo - 1].e > x.s, false)))"""


def _valid(kind: str) -> str:
    """SQL condition on a base hit ``x``: a failing match is dropped, not tried again."""
    digits = "regexp_replace(x.t, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": f"x.t rlike {_q(f'^{_PART}[.]{_PART}[.]{_PART}[.]{_PART}$')}",
        "card": f"luhn_check({digits})",
        "phone": f"length({digits}) between 8 and 15",
    }[kind]


def _kind_of_proposal() -> str:
    return r"""case
        when x.t rlike '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' then 'ssn'
        when x.t rlike '^[(0-9]' then 'phone'
        when x.t rlike '^[A-Z]{2}[0-9]{2}' then 'iban'
        when x.t rlike '[:=]' then 'secret'
        else 'name' end"""


def _either(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def _votes() -> dict[str, str]:
    """Each labeler's vote on a candidate ``x`` (kind, t, before, after) as SQL."""
    given, titles, tlds = _either(GIVEN), _either(TITLES), _either(DOMAINS)
    private = r"^(?:10|127|0|192[.]168|172[.](?:1[6-9]|2[0-9]|3[01]))[.]"
    issuers = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65|62)"
    return {
        "v_format": f"""case x.kind
            when 'email' then if(x.t rlike {_q(r'^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@.*[.][A-Za-z]{2,24}$')}, 1, -1)
            when 'ip' then if(x.t rlike {_q(r'^(?:[1-9][0-9]{0,2}[.])(?:[0-9]{1,3}[.]){2}[0-9]{1,3}$')}, 1, -1)
            when 'card' then if(x.t rlike {_q(r'^[0-9]{4}([ -]?)[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}')}, 1, 0)
            when 'phone' then if(length(regexp_replace(x.t, '[^0-9]', '')) between 10 and 15, 1, -1)
            when 'ssn' then if(x.t rlike {_q(r'^(?:000|666|9)|-00-|-0000$')}, -1, 1)
            when 'iban' then if(length(replace(x.t, ' ', '')) between 15 and 34, 1, -1)
            when 'secret' then if(x.t rlike '[0-9]' and x.t rlike '[A-Za-z]' and length(x.t) >= 24, 1, -1)
            else if(x.t rlike {_q(rf'^{titles}[.]? ')}, 1, 0) end""",
        "v_gazetteer": f"""case x.kind
            when 'email' then if(lower(x.t) rlike {_q(rf'[.]{tlds}$')}, 1, -1)
            when 'ip' then if(x.t rlike {_q(private)}, -1, 1)
            when 'card' then if(x.t rlike {_q(issuers)}, 1, -1)
            when 'phone' then if(x.t rlike {_q(rf'^[+]{_either(DIALLING)}')}, 1, 0)
            when 'iban' then if(x.t rlike {_q(rf'^{_either(IBAN)}')}, 1, -1)
            when 'secret' then 1
            when 'name' then if(x.t rlike {_q(rf'(?:^| ){given}(?: |$)')}, 1, 0)
            else 0 end""",
        "v_context": f"""case
            when lower(x.before) rlike {_q(rf'(?:^|[^a-z]){_either(ASKED)}[^a-z]*(?:[a-z]+[^a-z]+)?$')} then 1
            when lower(x.before) rlike {_q(rf'(?:^|[^a-z]){_either(COUNTED)}[^a-z]*$')} then -1
            else 0 end""",
        "v_ends": f"if(x.before rlike {_q(r'[\p{L}\p{N}]$')} or x.after rlike {_q(r'^[\p{L}\p{N}]')}, -1, 1)",
    }


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with an array column ``_found``: kind, base, s, e, the votes, and the
    classifier's further features size and digits (both bucketed)."""
    names = [*BASE, "other"]
    patterns = {**BASE, "other": PROPOSED}
    kept = [docs[c] for c in docs.columns]
    step = docs.select(*kept, F.coalesce(docs[text], F.lit("")).alias("_text"))
    step = step.select("*", *[F.regexp_extract_all("_text", F.lit(patterns[n]), F.lit(0)).alias(f"h_{n}") for n in names])
    step = step.select("*", *[
        F.when(F.size(f"h_{n}") > 0, F.split("_text", patterns[n], -1)).alias(f"p_{n}") for n in names])
    step = step.select(*docs.columns, *[_located(n).alias(f"l_{n}") for n in names])
    step = step.select(*docs.columns, "l_other", *[F.expr(f"filter(l_{k}, x -> {_valid(k)})").alias(f"b_{k}") for k in BASE])
    as_base = [f"transform(b_{k}, x -> struct('{k}' as kind, true as base, x.s, x.e, x.t, x.before, x.after))" for k in BASE]
    free = f"""transform(filter(l_other, x -> not ({' or '.join(_meets(f'b_{k}') for k in BASE)})),
        x -> struct({_kind_of_proposal()} as kind, false as base, x.s, x.e, x.t, x.before, x.after))"""
    step = step.select(*docs.columns, F.expr(f"concat({', '.join(as_base)}, {free})").alias("c"))
    votes = ", ".join(f"{sql} as {name}" for name, sql in _votes().items())
    return step.select(*docs.columns, F.expr(f"""transform(c, x -> struct(x.kind, x.base, x.s, x.e, {votes},
        cast(least(4, (x.e - x.s) div 8) as int) as size,
        cast(4 * length(regexp_replace(x.t, '[^0-9]', '')) / length(x.t) as int) as digits))""").alias("_found"))


def estimate(counts: list[tuple], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Expectation-maximisation over (kind, votes..., n) rows: the posterior of every
    (kind, votes) pattern. Reliabilities start from the majority of the votes."""
    posterior = {}
    for kind, *votes, _ in counts:
        total = sum(votes)
        posterior[(kind, *votes)] = 0.9 if total > 0 else 0.1 if total < 0 else 0.5
    for _ in range(rounds):
        share: dict[str, list[float]] = {}
        rate = {(j, y, v): 0.5 for j in range(len(LABELERS)) for y in (0, 1) for v in (-1, 0, 1)}
        for kind, *votes, n in counts:
            p = posterior[(kind, *votes)]
            yes, every = share.setdefault(kind, [0.5, 1.0])
            share[kind] = [yes + n * p, every + n]
            for j, v in enumerate(votes):
                rate[j, 1, v] += n * p
                rate[j, 0, v] += n * (1 - p)
        total = {(j, y): sum(rate[j, y, v] for v in (-1, 0, 1)) for j in range(len(LABELERS)) for y in (0, 1)}
        for kind, *votes, _ in counts:
            yes, every = share[kind]
            odds = math.log(yes / (every - yes))
            for j, v in enumerate(votes):
                odds += math.log(rate[j, 1, v] / total[j, 1]) - math.log(rate[j, 0, v] / total[j, 0])
            posterior[(kind, *votes)] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return posterior


def _terms(kind: str, votes: list[int], size: int, digits: int) -> list[str]:
    return [f"kind:{kind}", *[f"{name}:{v}" for name, v in zip(LABELERS, votes)], f"size:{size}", f"digits:{digits}"]


def train(rows: list[tuple[list[str], float, float]], steps: int = 400, pull: float = 1e-3) -> dict[str, float]:
    """Logistic weights of terms from (terms, posterior, n) rows, by gradient ascent with
    per-term steps; terms never seen weigh nothing."""
    weights = {t: 0.0 for terms, _, _ in rows for t in terms}
    total = sum(n for _, _, n in rows) or 1.0
    power = dict.fromkeys(weights, 1e-8)
    for _ in range(steps):
        gradient = {t: -pull * w for t, w in weights.items()}
        for terms, p, n in rows:
            z = sum(weights[t] for t in terms)
            miss = (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) * n / total
            for t in terms:
                gradient[t] += miss
        for t, g in gradient.items():
            power[t] += g * g
            weights[t] += 0.5 * g / math.sqrt(power[t])
    return weights


def fit(found: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """The span classifier's weights from all candidates of ``found`` (with_candidates).

    What reaches the driver is one row per combination of kind, votes, size and digit share
    - at most a few thousand however large the corpus."""
    spans = found.select(F.explode("_found").alias("x")).select("x.*")
    combos = [tuple(r) for r in spans.groupBy("kind", *LABELERS, "size", "digits").count().collect()]
    combos.sort()
    patterns: dict[tuple, int] = {}
    for kind, *rest in combos:
        key = (kind, *rest[:len(LABELERS)])
        patterns[key] = patterns.get(key, 0) + rest[-1]
    posterior = estimate([(*k, n) for k, n in patterns.items()], rounds)
    v = len(LABELERS)
    return train([(_terms(kind, rest[:v], rest[v], rest[v + 1]), posterior[(kind, *rest[:v])], rest[v + 2])
                  for kind, *rest in combos])


def _chosen(weights: dict[str, float]) -> str:
    """SQL: the spans of ``_found`` that stay, in order of kind and start."""
    def lookup(prefix: str, value: str) -> str:
        own = {t.split(":", 1)[1]: w for t, w in weights.items() if t.startswith(f"{prefix}:")}
        arms = " ".join(f"when '{k}' then {w!r}D" for k, w in sorted(own.items()))
        return f"case cast({value} as string) {arms} else 0D end" if arms else "0D"

    logit = " + ".join([lookup("kind", "x.kind"), *[lookup(n, f"x.{n}") for n in LABELERS],
                        lookup("size", "x.size"), lookup("digits", "x.digits")])
    order = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    seen = "_found" if weights else "filter(_found, x -> x.base)"
    return f"""array_sort(transform(filter({seen}, x -> x.base or ({logit}) >= 0D),
        x -> struct(array_position({order}, x.kind) as k, x.s, x.e, x.kind, x.base)))"""


def _line(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.s, x.e)), ',')"


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: the id, base counts per kind, ``base`` and ``spans`` as
    kind:start:end lists, and ``found`` with every span that stays.

    Candidates are written once to the checkpoint folder; the model and the result both
    read them, so the texts are matched once."""
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("_body"))
    found = materialize(with_candidates(rows, "_body").drop("_body"), "pii-candidates")
    chosen = found.select("_key", F.expr(_chosen(fit(found))).alias("spans"))
    chosen = chosen.select("_key", "spans", F.expr("filter(spans, x -> x.base)").alias("base"))
    return chosen.select(
        F.col("_key").alias(key),
        *[F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE],
        F.expr(_line("base")).alias("base"),
        F.expr(_line("spans")).alias("spans"),
        F.expr("transform(spans, x -> struct(x.kind, x.s as start, x.e as end, x.base))").alias("found"),
    )


def _between(start: str, end: str) -> str:
    """SQL: the text from ``start`` to ``end``, from its pieces ``_chunks``: only those in
    between are walked."""
    first = f"({start} - q * {CHUNK})"
    return f"""if({end} > {start}, array_join(transform(
        sequence(cast({start} div {CHUNK} as int), cast(({end} - 1) div {CHUNK} as int)), q -> substring(_chunks[q],
          greatest({first}, 0) + 1, least({end} - q * {CHUNK}, {CHUNK}) - greatest({first}, 0))), ''), '')"""


def redact(docs: DataFrame, text: str = "text", count: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are
    replaced together under the first one's kind.

    The rows are written once with their candidates to the checkpoint folder; the model is
    fitted on them and the texts are cut from them, so the texts are matched once."""
    names = [f"_{n}" for n in range(len(docs.columns))]  # the caller's names cannot clash with ours
    body, inner = names[docs.columns.index(text)], docs.toDF(*names)
    found = materialize(with_candidates(inner, body), "pii-candidates")
    step = found.select(*names, F.expr(_chosen(fit(found))).alias("_spans"))
    step = step.select(*names, F.expr(
        "array_sort(transform(_spans, x -> struct(x.s as s, -x.e as e, x.kind as kind)))").alias("_spans"))
    cut = "struct<s: int, e: int, kind: string>"
    span = "named_struct('s', _spans[i].s, 'e', -_spans[i].e, 'kind', _spans[i].kind)"
    # carried is the span that later ones may still widen; it is put out when one starts behind it
    step = step.select(*names, "_spans", F.expr(f"""if(size(_spans) > 0, {_folded(
        'size(_spans)', f'cast(null as {cut})', cut, f"""case
            when a.c is null then named_struct('c', {span}, 'out', a.out)
            when _spans[i].s < a.c.e then named_struct(
              'c', named_struct('s', a.c.s, 'e', greatest(a.c.e, -_spans[i].e), 'kind', a.c.kind), 'out', a.out)
            else named_struct('c', {span}, 'out', array_append(a.out, a.c)) end""")}, null)""").alias("_merged"))
    step = step.select(*names, F.expr("if(_merged is null, null, array_append(_merged.out, _merged.c))").alias("_cuts"))
    step = step.select(*names, "_cuts", F.expr(
        f"if(_cuts is null, null, regexp_extract_all({body}, '(?s).{{1,{CHUNK}}}', 0))").alias("_chunks"))
    before = "if(i = 0, 0, _cuts[i - 1].e)"
    clean = f"""if(_cuts is null, {body}, concat(
        array_join(transform(_cuts, (x, i) -> concat({_between(before, 'x.s')}, '[', upper(x.kind), ']')), ''),
        {_between('element_at(_cuts, -1).e', f'length({body})')}))"""
    out = step.withColumn("_clean", F.expr(clean))
    return out.select(*[
        F.col("_clean").alias(c) if c == text
        else F.when(F.col("_cuts").isNull(), F.col(n)).otherwise(F.length("_clean")).cast(t).alias(c) if c == count
        else F.col(n).alias(c) for n, (c, t) in zip(names, docs.dtypes)])
