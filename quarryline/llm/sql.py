"""SQL counterparts of the queries that SQL can express, for whole tables."""

from __future__ import annotations

from quarryline.llm import merkle, mixing

# Sources share by weight until none is above its limit; documents of a source are taken by
# rank until the cut that ends nearest to what is wanted.  The random number is that of the id.
PARETO_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source,
         COALESCE(len(regexp_extract_all(text, '{mixing.WORD}')), 0)::BIGINT AS size
  FROM documents
), totals AS (
  SELECT source, SUM(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, {mixing.MOST_COPIES} * source_size AS most,
         {list(mixing.SOURCE_WEIGHTS)}[
           1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(mixing.SOURCE_WEIGHTS)}] AS weight
  FROM totals
), levels AS (
  SELECT *, most::DOUBLE / weight AS turn,
         ({mixing.SHARE}::DOUBLE * SUM(source_size) OVER ()::DOUBLE
           - COALESCE(SUM(most) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / SUM(weight) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM weighed
), filled AS (
  SELECT source, source_size, most, weight,
         (SELECT arg_min(level, turn) FROM levels WHERE level <= turn) AS final
  FROM levels
), shared AS (
  SELECT source, source_size, COALESCE(LEAST(final * weight, most::DOUBLE), most::DOUBLE) AS target FROM filled
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS ratio FROM shared
), odds AS (
  SELECT *, floor(ratio + 1e-12::DOUBLE)::BIGINT AS whole,
         GREATEST(ratio - floor(ratio + 1e-12::DOUBLE), 0.0::DOUBLE) AS inclusion
  FROM planned
), drawn AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.inclusion, p.inclusion * p.source_size AS wanted,
         (('0x' || substr(md5('0:' || COALESCE(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
           / {16**13}::DOUBLE AS u
  FROM sized d JOIN odds p ON d.source IS NOT DISTINCT FROM p.source
), ratios AS (
  SELECT *, CASE WHEN inclusion > 0 THEN (u / (1 - u)) * ((1 - inclusion) / inclusion) END AS q FROM drawn
), ranked AS (
  SELECT *, q / (1 + q) AS rank FROM ratios
), runs AS (
  SELECT source, rank, wanted, SUM(SUM(size)) OVER (PARTITION BY source ORDER BY rank)::DOUBLE AS reached,
         SUM(size)::DOUBLE AS words
  FROM ranked WHERE rank IS NOT NULL GROUP BY source, rank, wanted
), edges AS (
  SELECT source, arg_max(rank, rank) AS last,
         arg_max(reached - wanted <= wanted - (reached - words), rank) AS last_taken
  FROM runs WHERE reached - words < wanted GROUP BY source
), taken AS (
  SELECT r.*, r.whole + CASE WHEN r.rank < e.last OR (r.rank = e.last AND e.last_taken) THEN 1 ELSE 0 END AS copies
  FROM ranked r LEFT JOIN edges e ON r.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, round(target, 3) AS target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies
FROM taken
"""

_ENDS = ", ".join(f"'{x}'" for x in merkle.SECTION_ENDS)


def _print(name: str) -> str:
    """Columns of the tree called ``name``: its leaves, its sections by first digits, its fingerprint."""

    def joined(digits: int) -> str:
        leaf = f"substr(x, 1, {digits}) || CASE WHEN x[1] IN ({_ENDS}) THEN '.' ELSE '' END"
        return f"COALESCE(array_to_string(list_transform({name}_hashes, lambda x: {leaf}), ''), '')"

    sections = f"list_filter(string_split({joined(32)}, '.'), lambda s: s <> '')"
    root = f"sha256(COALESCE(array_to_string(list_transform({sections}, lambda s: md5(s)), ''), ''))"
    return f"""
         list_distinct(list_transform({name}_hashes, lambda x: substr(x, 1, {merkle.LEAF_DIGITS}))) AS {name}_leaves,
         list_filter(string_split({joined(merkle.LEAF_DIGITS)}, '.'), lambda s: s <> '') AS {name}_sections,
         {root} || ':' || {joined(merkle.LEAF_DIGITS)} AS {name}_print"""


def _hashes(text: str, name: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '{merkle.PARAGRAPH}'), lambda x: md5(x)) AS {name}_hashes"


def _likeness(one: str, other: str) -> str:
    total = f"(len({one}_leaves) + len({other}_leaves))"
    return (
        f"CASE WHEN {one}_print = {other}_print OR {total} = 0 THEN 1.0::DOUBLE "
        f"ELSE 2.0::DOUBLE * len(list_intersect({one}_leaves, {other}_leaves)) / {total} END"
    )


# Ids are taken to be unique, as they are in ``documents``.
MERKLE_PRINTS = rf"""
WITH own AS (
  SELECT doc_id, COALESCE(text, '') AS body FROM documents
), following AS (
  SELECT doc_id, body, length(body) AS n,
         COALESCE(lead(body) OVER (ORDER BY doc_id NULLS FIRST), first_value(body) OVER (ORDER BY doc_id NULLS FIRST)) AS next
  FROM own
), changed AS (
  SELECT *, substr(body, 1, n - n // 4) || substr(next, 1, n // 4) AS edited FROM following
), hashed AS (
  SELECT doc_id, n, sha256(edited) AS edited_sha256,
         {_hashes("body", "own")}, {_hashes("edited", "edited")}, {_hashes("next", "next")}
  FROM changed
), printed AS (
  SELECT doc_id, n, edited_sha256, {_print("own")}, {_print("edited")}, {_print("next")}
  FROM hashed
)
SELECT doc_id, n::BIGINT AS n_chars, edited_sha256, own_print AS fingerprint, edited_print AS edited_fingerprint,
       {_likeness("own", "edited")} AS near_edited, {_likeness("own", "next")} AS near_next,
       len(list_distinct(list_filter(own_sections, lambda s: NOT list_contains(edited_sections, s))))::BIGINT AS n_differing
FROM printed
"""

SQL = {"op5_pareto_mix": PARETO_MIX, "op9_merkle_prints": MERKLE_PRINTS}
