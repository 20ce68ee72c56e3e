"""Personal data by weak supervision (native DataFrame code).

Base spans come from fixed patterns. Further candidates come from looser patterns (names, street addresses, dates, account numbers, local phone numbers, social security
numbers, IBANs, addresses with a spelled-out at sign, long numbers that fail the card checksum). On every span seven labelers vote yes, no or nothing: the pattern, a gazetteer of
mail domains, issuer and country prefixes, reserved address ranges and years of birth, one of given names and street types (apart, as most of its candidates are neither), the words before it in general, a cue of the span's own kind, a checksum and the variety of its
digits. Expectation-maximisation over the counts of the at most 3**7 vote patterns estimates each labeler's reliability; the posteriors train the final classifier, naive Bayes over features of the
span, its votes and its surroundings. It decides on the candidates, and it judges every span: base spans always stay, but ``n_likely`` counts the spans that it takes for
personal, and ``risk`` is the probability that at least one is.

Positions are code points. The pieces between matches (``split``) and the matches (``regexp_extract_all``) of one
pattern alternate, so their lengths give all positions without a Python function.
Null text counts as empty; repeated rows give repeated results; empty tables give empty results; a text of any length is searched whole; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import read_documents, staged

BASE_KINDS = ("email", "ip", "card", "phone")
LOOSE_KINDS = ("email_words", "iban", "ssn", "birth", "phone_local", "number", "account", "street", "name")
#: Possessive quantifiers and \G guards give the same leftmost matches as the plain patterns, in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email_words": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]{1,63}+){1,4}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "birth": r"(?<![0-9./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9./-])",
    "phone_local": r"(?<![A-Za-z0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "number": r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![0-9])",
    "account": r"(?<![A-Za-z0-9.,/-])[0-9]{7,12}(?![A-Za-z0-9/-])",
    "street": r"(?<![A-Za-z0-9.])[0-9]{1,5}\x20[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{2,20}(?:\x20[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20}){0,2}(?![A-Za-z])",
    "name": r"(?<![A-Za-zÀ-ÿ])[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{2,20}\x20[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{2,20}(?![A-Za-zÀ-ÿ])",
}
MAIL_ENDINGS = "com|org|net|edu|gov|io|info|de|fr|es|it|uk|us|eu"
RESERVED_IPS = r"^(0|10|127|255|192\.168|169\.254)\."
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)"
#: Common given names, and words for streets at the end or the beginning of their names.
GIVEN_NAMES = (
    "ahmed alan albert alejandro alexander ali alice amanda amy ana andrea andrew angela anja anna anne antonio antoine ashley barbara benjamin bernd betty brandon brian camille carlos carmen carol catherine "
    "charles charlotte christian christine christopher claire claudia cynthia daniel david deborah diana diego donald dorothy edward elena elizabeth emily emma eric eva fatima felix fernando francisco frank gary "
    "george hans heike helen henri ibrahim ines isabel jacob james jan jane jason javier jean jennifer jeremy jessica joan john jonathan jose joseph juan julia julie jürgen karen karl katherine "
    "kevin klaus laura lauren linda lisa louis lucas lucia luis manuel marc margaret maria marie mark marta martin mary matthew michael michelle miguel mohammed monika nancy nathalie nicholas "
    "nicole olivia pablo patricia paul pedro peter petra philippe pierre rachel rebecca richard robert ruth ryan samuel sandra sara sarah scott sofia sophie stefan stephen steven susan thomas timothy ursula "
    "uwe victoria william wolfgang yusuf"
).split()
STREETS = "street|st|avenue|ave|road|rd|lane|ln|drive|dr|boulevard|blvd|court|square|terrace|way|place|strasse|straße|weg|platz|allee|gasse|rue|calle|plaza|avenida|chemin|camino"
_LINK = r"(?:[\x20]*(?:is|of|no|number|on|at|in|to|by|id|the))*[^A-Za-z]*$"
YES_WORDS = (
    r"(?i)(e-?mail|contact|write to|phone|tel|call|fax|card|account|acct|iban|ssn|social security|address|ip|host|server|visa|mastercard|name|dear|mrs?|ms|dr|patient|signed|sincerely|born|birth|dob|lives|resident"
    r"|ship|passport|customer|konto|kontonummer|compte|cuenta|nom|nombre)" + _LINK
)
NO_WORDS = r"(?i)(version|section|chapter|figure|page|isbn|order|item|total|number of|no\.)[^A-Za-z]*$"
#: Words that tell of one kind.
CUES = {
    "name": "name|dear|mrs?|ms|dr|contact|patient|signed|sincerely|nom|nombre",
    "street": "address|lives|resident|ship|deliver|located|adresse|calle",
    "birth": "born|birth|dob|geboren|né|née|nacid[oa]",
    "account": "account|acct|passport|customer|konto|kontonummer|compte|cuenta|member|policy",
    "ssn": "ssn|social security", "iban": "iban|account|konto", "phone_local": "phone|tel|call|fax|mobile", "phone": "phone|tel|call|fax|mobile",
    "email": "e-?mail|contact|write", "email_words": "e-?mail|contact|write", "card": "card|visa|mastercard|amex", "number": "card|visa|mastercard|amex", "ip": "ip|host|client",
}
LABELERS = ("pattern", "gazetteer", "names", "context", "cue", "checksum", "digits")
#: Least share of right votes of a labeler in either class: a labeler that mostly votes no on its own, as on pairs of capitalised words, would turn the classes around else.
BETTER = 0.6
#: Shares of yes votes in the class without and with personal data that EM begins with, counted as so many votes; one random number in ten passes a checksum.
CHANCE, CHECKSUM, SMOOTH = (0.35, 0.75), (0.1, 0.95), 10
CONTEXT_CHARS = 24
#: Matches whose positions are added up in one array.
BLOCK = 256

_SPAN = "struct<kind:string,start:int,end:int,value:string,left:string,right:string>"


def _matches(kind: str, text: Column, pattern: str, needs: str | None) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.contains(needs), found).otherwise(F.array().cast("array<string>")) if needs else found


def _spans(kind: str, text: str, matches: str, pattern: str) -> Column:
    """Array of spans of one pattern; the text is split only where it has matches.

    The end of a match is the running total of the lengths of gaps and matches; arrays grow by copying, so totals run over blocks of
    ``BLOCK`` matches and over the blocks' sums.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    running = lambda items, start: f"""aggregate({items}, named_struct('at', {start}, 'out', cast(array() as array<int>)),
      (a, x) -> named_struct('at', a.at + x, 'out', concat(a.out, array(a.at + x))), a -> a.out)"""  # noqa: E731
    return F.expr(f"""
      if(size({matches}) = 0, cast(array() as array<{_SPAN}>),
        flatten(transform(
          transform(
            transform(
            transform(
              transform(array(split({text}, '{quoted}', -1)), gaps -> struct(gaps, transform({matches}, (m, i) -> length(get(gaps, i)) + length(m)) as steps)),
              g -> struct(g.gaps, transform(sequence(0, (size(g.steps) - 1) div {BLOCK}), k -> slice(g.steps, k * {BLOCK} + 1, {BLOCK})) as blocks)),
            g -> struct(g.gaps, g.blocks, {running("transform(g.blocks, b -> aggregate(b, 0, (z, x) -> z + x))", "0")} as upto)),
            g -> struct(g.gaps, flatten(transform(g.blocks, (b, k) -> {running("b", "if(k = 0, 0, get(g.upto, k - 1))")})) as ends)),
          g -> transform({matches}, (m, i) -> named_struct('kind', '{kind}', 'start', get(g.ends, i) - length(m), 'end', get(g.ends, i),
                 'value', m, 'left', right(get(g.gaps, i), {CONTEXT_CHARS}), 'right', left(get(g.gaps, i + 1), 1))))))""")


def _overlaps(span: str, others: str) -> str:
    """SQL condition: ``span`` overlaps one of ``others``, disjoint and in order. Halving finds the last that starts before its end."""
    return f"""(size({others}) > 0 and aggregate(sequence(0, cast(ceil(log2(size({others}) + 1)) as int)), named_struct('lo', 0, 'hi', size({others})),
      (r, _) -> if(r.lo >= r.hi, r, if(get({others}, shiftright(r.lo + r.hi, 1)).start < {span}.end,
        named_struct('lo', shiftright(r.lo + r.hi, 1) + 1, 'hi', r.hi), named_struct('lo', r.lo, 'hi', shiftright(r.lo + r.hi, 1)))),
      r -> coalesce(get({others}, r.lo - 1).end > {span}.start, false)))"""


def digits_of(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def luhn(value: str) -> str:
    """SQL condition: the digits of ``value`` pass the Luhn check."""
    d = f"cast(substring(reverse({digits_of(value)}), i, 1) as int)"
    return f"(aggregate(sequence(1, length({digits_of(value)})), 0, (z, i) -> z + if(i % 2 = 1, {d}, {d} * 2 - if({d} > 4, 9, 0))) % 10 = 0)"


#: SQL conditions that a match ``s`` of each base kind has to meet.
HOLDS = {
    "email": "true",
    "ip": r"forall(split(s.value, '\\.'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(ltrim('0', p), 3)) as int) <= 255)",
    "card": f"length({digits_of('s.value')}) between 13 and 19 and {luhn('s.value')}",
    "phone": f"length({digits_of('s.value')}) between 9 and 15",
}


def candidate_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, an array of spans per base kind, and the looser candidates that overlap none of them."""
    out = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    loose = "|".join(f"(?:{p})" for p in LOOSE.values())
    needs = {"email": "@", "phone": "+"}
    for kind, pattern in PATTERNS.items():
        out = out.withColumn(f"m_{kind}", _matches(kind, F.col("t"), pattern, needs.get(kind)))
    out = out.withColumn("m_loose", F.regexp_extract_all("t", F.lit(loose), F.lit(0)))
    for kind, pattern in PATTERNS.items():
        out = out.withColumn(kind, _spans(kind, "t", f"m_{kind}", pattern))
    out = out.withColumn("loose", _spans("loose", "t", "m_loose", loose))
    out = out.select("id", *[F.expr(f"filter({k}, s -> {HOLDS[k]})").alias(k) for k in BASE_KINDS], "loose")
    kind = "case " + " ".join(f"when rlike(s.value, '{'^(?:' + p.replace(chr(92), chr(92) * 2) + ')$'}') then '{k}'" for k, p in LOOSE.items()) + " else 'number' end"
    clear = f"filter(loose, s -> not ({' or '.join(_overlaps('s', k) for k in BASE_KINDS)}))"
    named = f"transform({clear}, s -> named_struct('kind', {kind}, 'start', s.start, 'end', s.end, 'value', s.value, 'left', s.left, 'right', s.right))"
    return out.withColumn("loose", F.expr(named))


def _vote(yes: str, no: str) -> str:
    return f"case when {yes} then 1 when {no} then -1 else 0 end"


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


VOTES = {
    "pattern": _vote("s.kind in ('email', 'ip', 'card', 'phone')", "s.kind in ('number', 'account', 'birth')"),
    "gazetteer": "case "
    f"when s.kind in ('email', 'email_words') then if(rlike(lower(s.value), '(\\\\.|dot.? ?)({MAIL_ENDINGS})$'), 1, -1) "
    f"when s.kind = 'ip' then if(rlike(s.value, '{_sql(RESERVED_IPS)}'), -1, 1) "
    f"when s.kind in ('card', 'number') then if(rlike(s.value, '{ISSUERS}'), 1, -1) "
    "when s.kind = 'ssn' then if(rlike(s.value, '^(000|666|9)'), -1, 1) "
    "when s.kind = 'birth' then if(cast(regexp_extract(s.value, '(19|20)[0-9][0-9]', 0) as int) between 1920 and 2015, 0, -1) "
    "when s.kind in ('phone', 'phone_local') then if(rlike(s.value, '^.?[01]00'), -1, 1) else 0 end",
    "names": "case "
    f"when s.kind = 'name' then if(array_contains(array({', '.join(repr(n) for n in GIVEN_NAMES)}), lower(substring_index(s.value, ' ', 1))), 1, -1) "
    f"when s.kind = 'street' then if(rlike(lower(s.value), '(^[0-9]+ ({STREETS}) )|( ({STREETS})$)|((strasse|straße|weg|platz|allee|gasse)$)'), 1, -1) "
    "else 0 end",
    "context": _vote(f"rlike(s.left, '(?<![A-Za-z]){_sql(YES_WORDS)}')", f"rlike(s.left, '{_sql(NO_WORDS)}')"),
    "cue": "case s.kind " + " ".join(f"when '{k}' then if(rlike(s.left, '(?i)(?<![A-Za-z])({w}){_sql(_LINK)}'), 1, 0)" for k, w in CUES.items()) + " else 0 end",
    "checksum": f"case when s.kind in ('card', 'number') then if({luhn('s.value')}, 1, -1) else 0 end",
    "digits": f"case when s.kind in ('email', 'email_words', 'ip', 'name', 'street', 'birth') then 0 when size(array_distinct(split({digits_of('s.value')}, ''))) < 4 then -1 else 1 end",
}
FEATURES = {
    "shape": "regexp_replace(regexp_replace(substring(s.value, 1, 24), '[A-Za-z]+', 'a'), '[0-9]', '9')",
    "length": "cast(least(s.end - s.start, 40) div 4 as string)",
    "before": "case when s.left = '' then 'edge' when rlike(s.left, '[A-Za-z]$') then 'letter' when rlike(s.left, '[0-9.,-]$') then 'number' when rlike(s.left, '[:=] ?$') then 'key' else 'other' end",
    "after": "case when s.right = '' then 'edge' when rlike(s.right, '[A-Za-z]') then 'letter' when rlike(s.right, '[0-9-]') then 'number' else 'other' end",
    "words": VOTES["context"],
    "cue": VOTES["cue"],
    "checksum": VOTES["checksum"],
    "list": VOTES["gazetteer"],
    "names": VOTES["names"],
    "kind": "s.kind",
}


def vote_columns(spans: str) -> Column:
    """Votes and features of every span, as an array."""
    votes = ", ".join(f"'{n}', {v}" for n, v in VOTES.items())
    # shapes are open-ended: hashed to 64 values, so the table of features stays small
    features = ", ".join(f"concat('{n}=', " + (f"pmod(xxhash64({v}), 64)" if n == "shape" else v) + ")" for n, v in FEATURES.items())
    return F.expr(f"transform({spans}, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, {votes}, 'features', array({features})))")


def estimate_reliability(patterns: list[tuple], rounds: int = 50) -> tuple[dict, list[float]]:
    """EM for two classes under the assumption that every labeler is better than chance (``BETTER``): P(vote | class) per labeler, and P(personal) per row of ``patterns`` (seven votes and a count)."""
    start = {n: CHECKSUM if n == "checksum" else CHANCE for n in LABELERS}
    prior, rates = 0.5, {n: {y: {1: start[n][y], -1: 1 - start[n][y]} for y in (1, 0)} for n in LABELERS}
    post: list[float] = []
    for _ in range(rounds):
        post = []
        for *votes, _n in patterns:
            like = {1: math.log(prior), 0: math.log(1 - prior)}
            for name, v in zip(LABELERS, votes, strict=True):
                if v:
                    for y in like:
                        like[y] += math.log(rates[name][y][v])
            post.append(1 / (1 + math.exp(min(50.0, like[0] - like[1]))))
        total = sum(p[-1] for p in patterns)
        if not total:
            break
        prior = min(0.99, max(0.01, sum(q * p[-1] for q, p in zip(post, patterns, strict=True)) / total))
        for i, name in enumerate(LABELERS):
            for y in (1, 0):
                # smoothing, and a bound towards better than chance, keep the two classes from changing places
                counts = {1: SMOOTH * start[name][y], -1: SMOOTH * (1 - start[name][y])}
                for q, p in zip(post, patterns, strict=True):
                    if p[i]:
                        counts[p[i]] += p[-1] * (q if y else 1 - q)
                share = counts[1] / sum(counts.values())
                share = min(0.98, max(BETTER, share)) if y else max(0.02, min(1 - BETTER, share))
                rates[name][y] = {1: share, -1: 1 - share}
    return rates, post


def train_classifier(voted: DataFrame) -> dict[str, float]:
    """Log-odds by feature (at most a few hundred) and of the prior (key ''), from the posteriors of all spans."""
    spans = voted.select(F.explode("spans").alias("s")).select("s.*")
    patterns = [tuple(r) for r in spans.groupBy(*LABELERS).count().orderBy(*LABELERS).collect()]  # at most 3**7 rows
    _, post = estimate_reliability(patterns)
    keyed = {",".join(map(str, p[:-1])): q for p, q in zip(patterns, post, strict=True)}
    if not keyed:
        return {"": -1.0}
    lookup = F.create_map(*[F.lit(x) for kv in keyed.items() for x in kv])
    spans = spans.withColumn("p", F.element_at(lookup, F.concat_ws(",", *[F.col(n).cast("string") for n in LABELERS])))
    sums = spans.select("p", F.explode("features").alias("feature")).groupBy("feature")
    rows = sums.agg(F.round(F.sum("p"), 6).alias("yes"), F.round(F.sum(1 - F.col("p")), 6).alias("no")).collect()  # features are bounded
    size = {n: sum(r["feature"].startswith(f"{n}=") for r in rows) for n in FEATURES}
    yes, no = (sum(r[c] for r in rows if r["feature"].startswith("kind=")) for c in ("yes", "no"))
    odds = {r["feature"]: math.log((r["yes"] + 1) / (yes + size[n])) - math.log((r["no"] + 1) / (no + size[n])) for r in rows for n in [r["feature"].split("=")[0]]}
    return odds | {"": math.log((yes + 1) / (no + 1))}


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base counts and digest, all spans as ``kind:start:end``, and how many the method added."""
    cands = candidate_spans(docs, id_col, text_col)
    slim = [F.expr(f"transform({k}, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end))").alias(k) for k in BASE_KINDS]
    voted = staged(cands.select("id", *slim, vote_columns("concat(email, ip, card, phone, loose)").alias("spans")), "pii")
    odds = train_classifier(voted)
    lookup = F.create_map(*[F.lit(x) for kv in odds.items() for x in kv])
    score = lambda s: F.aggregate(s["features"], F.lit(odds[""]), lambda a, f: a + F.coalesce(F.element_at(lookup, f), F.lit(0.0)))
    chance = lambda s: 1 / (1 + F.exp(-score(s)))
    judged = voted.withColumn("spans", F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), chance(s).alias("p"))))
    added = F.filter("spans", lambda s: s["kind"].isin(*LOOSE_KINDS) & (s["p"] > 0.5))
    show = lambda a: F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    of_kind = lambda k: F.array_sort(F.filter("added", lambda s: s["kind"] == k))
    by_kind = F.concat(*map(of_kind, LOOSE_KINDS))
    out = judged.withColumn("added", F.transform(added, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    out = out.withColumn("base", show(F.concat(*BASE_KINDS))).withColumn("more", show(by_kind))
    said = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS) | (s["p"] > 0.5))
    return out.select(
        F.col("id").alias(id_col),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join(F.concat("base", "more"), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
        F.size(F.filter("spans", lambda s: s["p"] > 0.5)).cast("long").alias("n_likely"),
        F.round(1 - F.aggregate(said, F.lit(1.0), lambda a, s: a * (1 - s["p"])), 6).alias("risk"),
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_documents(spark, sf_dir))
