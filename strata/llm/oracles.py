"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from strata.llm.collocations import Params
from strata.llm.curriculum import Plan


def _moment(share: str, knots) -> str:
    """Time at which a piecewise linear rate has summed up to ``share`` of its whole."""
    areas = [(b[1] + a[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:])]
    whole, upto, cases = sum(areas), 0.0, []
    starts = []
    left = whole
    for area in reversed(areas):
        left -= area
        starts.append(left)
    starts.reverse()
    for (t0, r0), (t1, r1), upto, area in zip(knots, knots[1:], starts, areas):
        slope = 2 * (r1 - r0) / (t1 - t0)
        more = f"greatest({share} * {whole!r}::DOUBLE - {upto!r}::DOUBLE, 0::DOUBLE)"
        at = f"least({t0!r}::DOUBLE + 2::DOUBLE * {more} / ({r0!r}::DOUBLE + sqrt(greatest({r0 * r0!r}::DOUBLE + {slope!r}::DOUBLE * {more}, 0::DOUBLE))), {t1!r}::DOUBLE)"
        cases.append((f"{share} * {whole!r}::DOUBLE >= {upto + area!r}::DOUBLE", at))
    out = cases[-1][1]
    for (beyond, at) in reversed(cases[:-1]):
        out = f"CASE WHEN {beyond} THEN {out} ELSE {at} END"
    return out


def curriculum_mix(plan: Plan = Plan()) -> str:
    """The targets by rounds of sharing out, not in closed form: a source that stops is
    left out of the next round."""
    p, q = plan.share
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(plan.weights))
    moments = " ".join(f"WHEN {i} THEN {_moment('y', k)}" for i, k in enumerate(plan.schedules))
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, CASE rank % {len(plan.weights)} {weights} END AS weight FROM s),
r AS (
  SELECT 0 AS round, source, rank, source_size, weight, false AS stopped FROM w
  UNION ALL
  SELECT round + 1, source, rank, source_size, weight,
         stopped OR (part * weight > {plan.most}::HUGEINT * source_size * {q} * open)
  FROM (SELECT *, {p}::HUGEINT * sum(source_size) OVER () - {q * plan.most} * coalesce(sum(source_size) FILTER (stopped) OVER (), 0) AS part,
               coalesce(sum(weight) FILTER (NOT stopped) OVER (), 0) AS open FROM r) x
  WHERE round < (SELECT count(*) FROM w)),
f AS (SELECT *, {p}::HUGEINT * sum(source_size) OVER () - {q * plan.most} * coalesce(sum(source_size) FILTER (stopped) OVER (), 0) AS part,
             coalesce(sum(weight) FILTER (NOT stopped) OVER (), 0) AS open
      FROM r WHERE round = (SELECT max(round) FROM r)),
t AS (SELECT source, rank, source_size,
             CASE WHEN stopped THEN ({plan.most} * source_size)::DOUBLE ELSE (part * weight)::DOUBLE / ({q} * open)::DOUBLE END AS target,
             CASE WHEN stopped THEN {plan.most} * source_size ELSE (part * weight // ({q} * open))::BIGINT END AS demand FROM f),
o AS (SELECT doc_id, size, source_size, target, demand, rank, coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id NULLS LAST, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t USING (source) WHERE d.source IS NOT NULL
      UNION ALL
      SELECT doc_id, size, source_size, target, demand, rank, coalesce(sum(size) OVER (ORDER BY o, doc_id NULLS LAST, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
      FROM d JOIN t ON d.source IS NULL AND t.source IS NULL),
k AS (SELECT *, (SELECT sum(least(greatest(demand - j * source_size - start, 0), size)) FROM range({plan.most}) x(j))::BIGINT AS taken,
             start::DOUBLE / greatest(demand, 1)::DOUBLE AS y FROM o)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN CASE rank % {len(plan.schedules)} {moments} END END AS position
FROM k"""


CURRICULUM_MIX = curriculum_mix()


def collocations(params: Params = Params()) -> str:
    """Every phrase of every piece counted as it stands, without chunks or filters."""
    upper = "".join(map(chr, range(65, 91)))
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
g AS (SELECT lang, len AS words, array_to_string(ws[i:i + len - 1], ' ') AS phrase
      FROM (SELECT lang, ws, len, unnest(range(1, len(ws) - len + 2)) AS i FROM w, range(1, {params.longest + 1}) l(len) WHERE len(ws) >= len)),
f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE words >= 2 AND f >= {params.least}),
cut AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:words], ' ') AS rp
        FROM (SELECT *, unnest(range(1, words)) AS k FROM c)),
scored AS (SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r, ({params.scale}::HUGEINT * a // (x.f + y.f))::BIGINT AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, over, array_to_string(ws[i:i + m - 1], ' ') AS phrase
           FROM (SELECT lang, a AS over, ws, m, unnest(range(1, words - m + 2)) AS i FROM c, range(2, {params.longest}) l(m) WHERE m < words)),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase AND 100::HUGEINT * i.over >= {params.covered}::HUGEINT * c.a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
           FROM best ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {params.top}"""


COLLOCATIONS = collocations()
