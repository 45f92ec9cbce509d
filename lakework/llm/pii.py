"""Personal data by weak supervision, in built-in functions only.

Patterns propose spans of four kinds. Five labelers vote for, against or abstain on each:
the strict pattern, the span's shape, a gazetteer of known parts, cue words before it and
signs that it is something else. How often each vote pattern occurs is counted over all
documents; expectation-maximisation estimates from these counts how reliable every
labeler is, without labels, and with that how likely each pattern is personal data. A
logistic span classifier is trained on these probabilities and decides about the spans
that the strict patterns do not take; what they take always stays.

Only counts of vote and feature patterns reach the driver: at most
``4 * 3**5 * 2**len(FEATURES)`` rows, whatever the input.
"""

import math

from pyspark.sql import functions as F

from lakework.llm.common import cut

KINDS = ["email", "ip", "card", "phone"]

#: The strict patterns. Possessive and anchored where the plain ones backtrack
#: or rescan; they match the same texts.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Spans that the strict patterns leave out.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+"
             r"(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9A-Za-z+().-])(?<![0-9+()] )\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}"
             r"(?![0-9])(?![ .-][0-9])",
}

#: What a text must hold for a loose pattern to be tried.
LOOSE_SIGN = {"email": r"[(\[]at[)\]]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9]", "phone": r"[0-9]"}

#: Parts that the gazetteer knows, as patterns over the span.
KNOWN = {
    "email": r"(?i)(?:\.|dot[)\]] ?)(?:com|org|net|edu|gov|int|info|io|fr|de|es|uk|eu|us|ch|at|it|nl)$",
    "ip": r"^(?:(?:1?[0-9]?[0-9]|2[01][0-9]|22[0-3])\.|[23][0-9A-Fa-f]{3}:|fe80:)",
    "card": r"^[3-6]",
    "phone": r"^(?:\+(?:1|3[0-9]|4[0-9]|5[0-9]|6[0-6]|7|8[1246]|9[0-58])|\(?0[1-9])",
}

#: Words before a span that announce its kind.
CUES = {
    "email": r"(?i)e-?mail|contact|write to|courriel|correo|kontakt|schreib",
    "ip": r"(?i)\bip\b|host|server|address|adresse|dirección",
    "card": r"(?i)card|visa|carte|karte|tarjeta|iban|account",
    "phone": r"(?i)\btel|phone|call|fax|mobile|t[ée]l[ée]phone|telefon|tel[ée]fono|rufen",
}

#: Text right before and right after a span that speaks against it.
AGAINST_BEFORE = r"(?i)(?:version|isbn|issn|doi|page|\bno\.?|[$€£#=/_]|[a-z0-9])[\x20]?$"
AGAINST_AFTER = r"^(?:[0-9A-Za-z_%€$]|\.[0-9])"

LABELERS = ["strict", "shape", "known", "cue", "against"]
FEATURES = ["known", "cue", "parted", "shaped", "bare_before", "bare_after"]
#: Characters before and after a span that labelers see.
CONTEXT = 24
#: Pseudo-counts: labelers are better than chance, the strict pattern by much.
PRIOR, PRIOR_STRICT = 2.0, 50.0
ROUNDS = 40


def _bound(value, body):
    """``body(x)`` with ``x`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _places(text, pattern):
    """All matches of a pattern in a text with their places in code points."""
    empty = F.array().cast("array<struct<start:int,end:int,span:string>>")

    def placed(matches):
        gaps = F.split(text, pattern, -1)
        return F.when(F.size(matches) > 0, _bound(gaps, lambda g: walked(g, matches))).otherwise(empty)

    def walked(gaps, matches):
        start = F.struct(F.lit(0).alias("end"), empty.alias("found"))

        def step(held, i):
            return _bound(
                F.struct(held["found"].alias("found"),
                         (held["end"] + F.length(F.get(gaps, i))).alias("start"),
                         F.get(matches, i).alias("span")),
                lambda s: F.struct(
                    (s["start"] + F.length(s["span"])).alias("end"),
                    F.concat(s["found"], F.array(F.struct(
                        s["start"].alias("start"), (s["start"] + F.length(s["span"])).alias("end"),
                        s["span"].alias("span")))).alias("found")))

        return F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), start, step)["found"]

    return _bound(F.regexp_extract_all(text, F.lit(pattern), 0), placed)


def _digits(span):
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(span):
    """Whether 13 to 19 digits pass the Luhn check; false for any other number of them."""
    def checked(digits):
        def weighed(total, place):
            d = F.substr(digits, F.length(digits) - place, F.lit(1)).cast("int")
            doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return total + F.when(place % 2 == 1, doubled).otherwise(d)

        total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), weighed)
        return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)

    return _bound(_digits(span), checked)


def passes(kind, span):
    """Whether a match of the strict pattern is kept."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return span.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    n = F.length(_digits(span))
    return n.between(8, 15) if kind == "phone" else n.between(16, 19) & luhn(span)


def _shaped(kind, span):
    """Whether the span looks as most of its kind do; null if that says little."""
    if kind == "email":
        return span.rlike(r"^[A-Za-z0-9]") & span.rlike(r"[A-Za-z]{2,6}$")
    if kind == "ip":
        return ~span.rlike(r"(^|\.)0[0-9]")
    if kind == "card":
        return luhn(span)
    return F.when(span.rlike(r"[ ().-]"), F.length(_digits(span)).between(9, 13))


def _candidate(text, kind, strict, place):
    """Votes and features of a span."""
    span = place["span"]
    before = F.substr(
        text, F.greatest(place["start"] - CONTEXT, F.lit(0)) + 1,
        F.least(place["start"], F.lit(CONTEXT)))
    after = F.substr(text, place["end"] + 1, F.lit(CONTEXT))
    vote = lambda yes: F.when(yes, 1).when(~yes, 0).otherwise(2)
    only = lambda sign, value: F.when(sign, value).otherwise(2)

    def judged(c):
        kept = passes(kind, span) if strict else F.lit(False)
        known, cue = span.rlike(KNOWN[kind]), c["before"].rlike(CUES[kind])
        bare_before = ~c["before"].rlike(AGAINST_BEFORE)
        bare_after = ~c["after"].rlike(AGAINST_AFTER)
        votes = [
            vote(kept) if strict else F.lit(2), vote(_shaped(kind, span)), vote(known), only(cue, 1),
            only(~(bare_before & bare_after), 0)]
        features = [
            known, cue, span.rlike(r"[ ().:-]"), F.coalesce(_shaped(kind, span), F.lit(False)),
            bare_before, bare_after]
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), place["start"].alias("start"),
            place["end"].alias("end"), kept.alias("base"),
            sum((v * 3 ** i for i, v in enumerate(votes)), F.lit(0)).alias("votes"),
            sum((f.cast("int") * 2 ** i for i, f in enumerate(features)), F.lit(0)).alias("features"))

    return _bound(F.struct(before.alias("before"), after.alias("after")), judged)


def _judging(text, kind, strict):
    return lambda place: _candidate(text, kind, strict, place)


def candidates(text):
    """All proposed spans of a text, strict ones first in each kind."""
    found = []
    for kind in KINDS:
        strict = _places(text, STRICT[kind])
        loose = F.when(text.rlike(LOOSE_SIGN[kind]), _places(text, LOOSE[kind])).otherwise(
            F.array().cast("array<struct<start:int,end:int,span:string>>"))
        found.append(F.transform(strict, _judging(text, kind, True)))
        found.append(F.transform(loose, _judging(text, kind, False)))
    return F.concat(*found)


def reliabilities(counts):
    """Posteriors of vote patterns by expectation-maximisation.

    ``counts`` maps ``(kind, votes)`` to a number of spans. Returns, per kind, how likely it
    is personal data at all and the chance of each vote (against, for, abstain) of every
    labeler given that it is or is not; and the posterior of each pattern.
    """
    models, posterior = {}, {}
    for kind in range(len(KINDS)):
        rows = {v: n for (k, v), n in counts.items() if k == kind}
        votes = {v: [v // 3 ** i % 3 for i in range(len(LABELERS))] for v in rows}
        share = {
            v: (1 + sum(x == 1 for x in votes[v])) / (2 + sum(x != 2 for x in votes[v])) for v in rows}
        for _ in range(ROUNDS):
            yes = sum(n * share[v] for v, n in rows.items())
            prior = (yes + 1) / (sum(rows.values()) + 2)
            tables = []
            for i, name in enumerate(LABELERS):
                belief = PRIOR_STRICT if name == "strict" else PRIOR
                told = [[1 + belief, 1.0, 1.0], [1.0, 1 + belief, 1.0]]
                for v, n in rows.items():
                    told[1][votes[v][i]] += n * share[v]
                    told[0][votes[v][i]] += n * (1 - share[v])
                tables.append([[x / sum(row) for x in row] for row in told])
            for v in rows:
                odds = math.log(prior / (1 - prior)) + sum(
                    math.log(t[1][x] / t[0][x]) for t, x in zip(tables, votes[v], strict=True))
                share[v] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        if rows:
            models[KINDS[kind]] = (prior, tables)
        posterior.update({(kind, v): p for v, p in share.items()})
    return models, posterior


def train(counts, posterior, steps=300, rate=1.0, penalty=0.01):
    """Weights of the span classifier per kind: one per feature and an intercept, last.

    ``counts`` maps ``(kind, votes, features)`` to a number of spans, whose labels are the
    posteriors of their votes.
    """
    weights = {}
    for kind in range(len(KINDS)):
        rows = {}
        for (k, v, f), n in counts.items():
            if k == kind:
                seen, yes = rows.get(f, (0, 0.0))
                rows[f] = seen + n, yes + n * posterior[k, v]
        total = sum(n for n, _ in rows.values())
        w = [0.0] * (len(FEATURES) + 1)
        inputs = {f: [f >> i & 1 for i in range(len(FEATURES))] + [1] for f in rows}
        for _ in range(steps if rows else 0):
            slope = [penalty * x for x in w[:-1]] + [0.0]
            for f, (n, yes) in rows.items():
                p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, inputs[f], strict=True))))
                for i, x in enumerate(inputs[f]):
                    slope[i] += x * (n * p - yes) / total
            w = [a - rate * s for a, s in zip(w, slope, strict=True)]
        weights[kind] = w if rows else [0.0] * len(FEATURES) + [-50.0]
    return weights


def _probability(span, weights):
    score = F.lit(0.0)
    for kind, w in weights.items():
        own = F.lit(w[-1])
        for i, x in enumerate(w[:-1]):
            own = own + F.shiftright(span["features"], i).bitwiseAND(1) * F.lit(x)
        score = F.when(span["kind"] == kind, own).otherwise(score)
    return 1 / (1 + F.exp(-score))


def _listed(spans):
    """``kind:start:end`` of spans in order of kind and start, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def detected(docs, keep=()):
    """Spans of every row: ``base`` (kept by the strict patterns) and ``spans`` (with those that
    the classifier adds), both arrays of structs with ``kind`` (a place in ``KINDS``), ``start``
    and ``end``; columns in ``keep`` are carried along.

    An added span overlaps no strict one, and of added ones that overlap the one listed
    first stays. The model is fitted on all rows of ``docs``. Null texts count as empty and
    have no spans; repeated rows give repeated rows; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = cut(docs.select(*keep, text.alias("_text")).select(
        *keep, candidates(F.col("_text")).alias("found")), "spans")
    counted = rows.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes", "s.features") \
        .count().collect()  # bounded by the number of patterns
    counts = {(r["kind"], r["votes"], r["features"]): r["count"] for r in counted}
    by_votes = {}
    for (kind, votes, _), n in counts.items():
        by_votes[kind, votes] = by_votes.get((kind, votes), 0) + n
    _, posterior = reliabilities(by_votes)
    weights = train(counts, posterior)
    base = F.filter("found", lambda s: s["base"])
    rows = rows.select(*keep, base.alias("base"), F.filter(
        "found", lambda s: ~s["base"] & (_probability(s, weights) >= 0.5)).alias("more"))

    def apart(held, s):
        meets = F.exists(held, lambda h: (h["start"] < s["end"]) & (s["start"] < h["end"]))
        return F.when(meets, held).otherwise(F.concat(held, F.array(s)))

    return rows.select(*keep, "base", F.aggregate("more", F.col("base"), apart).alias("spans"))


def personal_data(docs):
    """Counts and places of personal data, one row per row of ``docs``.

    Returns ``doc_id, n_email, n_ip, n_card, n_phone`` (strict spans), ``base_sha256`` of their
    list and ``spans``, the list of all. Edge cases are those of ``detected``.
    """
    rows = detected(docs, ["doc_id"])
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"))


def redact(docs, columns):
    """``docs`` with every span in ``text`` replaced by ``[EMAIL]``, ``[IP]`` and so on; other
    ``columns`` are kept as they are. Where spans overlap they are replaced as one, by the
    name of the first. Null texts stay null."""
    rows = detected(docs, columns)
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(held, s):
        inside = s["start"] < held["end"]
        piece = F.concat(
            F.substr("text", held["end"] + 1, s["start"] - held["end"]), F.get(names, s["kind"]))
        return F.struct(
            F.greatest(held["end"], s["end"]).alias("end"),
            F.when(inside, held["out"]).otherwise(F.concat(held["out"], piece)).alias("out"))

    start = F.struct(F.lit(0).alias("end"), F.lit("").alias("out"))
    done = F.aggregate(ordered, start, step)
    text = _bound(done, lambda d: F.concat(
        d["out"], F.substr("text", d["end"] + 1, F.length("text"))))
    return rows.withColumn("text", F.when(F.size("spans") > 0, text).otherwise(F.col("text"))).select(*columns)
