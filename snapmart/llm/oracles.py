"""SQL for the text queries that SQL can express.

The others rest on XXH64 of texts, on a tokenizer, a trained model, a compressor or on
reading HTML; their tests compare them with brute force.
"""

from __future__ import annotations

from snapmart.llm import decontamination as leaks, mixing, phrases

GAP = r"[\x20\x09-\x0D]+"
_P = mixing._PRIME


def _scrambled(value: str, salt: str) -> str:
    mixed = f"((({value}) % {_P} * 48271 + {salt}) % {_P})"
    squared = f"(({mixed} * {mixed} + 16807 + {salt}) % {_P})"
    return f"(({squared} * 69621 + {mixed}) % {_P})"


def _round_key(salt: str, turn: int) -> str:
    first = _scrambled(f"({salt})::BIGINT * 31 + {turn}", str(mixing.SEED))
    second = _scrambled(f"({salt})::BIGINT * 37 + {turn}", str(mixing.SEED + 1))
    return f"({first} * {_P}::BIGINT + {second})"


def _permuted(name: str, source: str, place: str, size: str, salt: str) -> str:
    """CTEs that add column ``name``: where ``place`` goes among ``size`` places."""
    steps = [f"{name}0 AS (SELECT *, ({place})::BIGINT AS {name} FROM {source})"]
    for turn in range(1, mixing.ROUNDS + 1):
        steps.append(f"""
{name}{turn}k AS (SELECT *, {_round_key(salt, turn)} AS k FROM {name}{turn - 1}),
{name}{turn}m AS (SELECT *, ((k % {size} - {name}) % {size} + {size}) % {size} AS mirror FROM {name}{turn}k),
{name}{turn} AS (SELECT * EXCLUDE ({name}, k, mirror),
  CASE WHEN {_scrambled(f'greatest({name}, mirror) + k % {_P}', str(mixing.SEED + 2))} % 2 = 1
    THEN mirror ELSE {name} END AS {name} FROM {name}{turn}m)""")
    return ",\n".join(steps)


def _mixing() -> str:
    block, last = mixing.BLOCK, f"{mixing.ROUNDS}"
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    return f"""
WITH sized AS (
  SELECT doc_id, source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda w: w <> ''))::BIGINT AS size
  FROM documents),
weighed AS (
  SELECT *, {weights}[(rank - 1) % {len(mixing.WEIGHTS)} + 1] AS weight, {mixing.MAX_TIMES} * source_size AS most
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM sized GROUP BY source)),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (
      ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here
  FROM weighed),
targets AS (
  SELECT *, coalesce(least(level * weight, most::DOUBLE), most::DOUBLE) AS target
  FROM (SELECT *, (SELECT here FROM levels WHERE here * weight <= most
                   ORDER BY source_size / weight, rank LIMIT 1) AS level FROM levels)),
placed AS (
  SELECT row_number() OVER () AS row, s.doc_id, s.size, t.rank, t.source_size, t.target,
    coalesce(sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.doc_id NULLS LAST, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
counts AS (
  SELECT rank, n_blocks,
    least(floor(target * n_blocks / source_size + 0.5), {mixing.MAX_TIMES} * n_blocks)::BIGINT AS slots
  FROM (SELECT *, ceil(source_size / {block})::BIGINT AS n_blocks FROM targets WHERE source_size > 0)),
slots AS (
  SELECT rank, n_blocks, slot, (slot // n_blocks)::BIGINT AS pass
  FROM (SELECT *, unnest(range(slots)) AS slot FROM counts WHERE slots > 0)),
{_permuted('b', 'slots', '(slot + pass * 7919) % n_blocks', 'n_blocks', 'rank')},
pieces AS (
  SELECT *, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) AS block_no
  FROM placed WHERE size > 0),
taken AS (
  SELECT p.row, sum(least(start + size, (block_no + 1) * {block}) - greatest(start, block_no * {block})) AS taken
  FROM pieces p JOIN b{last} s ON s.rank = p.rank AND s.b = p.block_no GROUP BY p.row)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM placed LEFT JOIN taken USING (row)"""


def _decontamination() -> str:
    def tokens(text: str) -> str:
        split = rf"regexp_split_to_array(lower(coalesce({text}, '')), '[^\p{{L}}\p{{N}}]+')"
        return f"list_filter({split}, lambda w: w <> '')"

    def seeds(table: str, key: str) -> str:
        parts = []
        for number, seed in enumerate(leaks.SEEDS):
            read = ", ".join(f"t[pos + {o + 1}], t[pos + {o + 2}]" for o in seed)
            parts.append(f"""SELECT {key}, {number} AS mask, pos, concat_ws(' ', {read}) AS seed
              FROM (SELECT {key}, t, unnest(range(len(t) - {seed[-1] + 1})) AS pos FROM {table})""")
        return " UNION ALL ".join(parts)

    # Items too short for the masks, by their parts.
    layout = [(n, start, size) for n in range(1, leaks.MIN_OVERLAP) for start, size in leaks.parts_of(n)]
    sizes = sorted({size for _, _, size in layout})
    windows = " UNION ALL ".join(f"""
  SELECT doc_row, {len(leaks.SEEDS) + size} AS mask, pos, array_to_string(t[pos + 1:pos + {size}], ' ') AS seed
  FROM (SELECT doc_row, t, unnest(range(len(t) - {size - 1})) AS pos FROM docs WHERE len(t) >= {size})
  WHERE {size} IN (SELECT size FROM item_parts)""" for size in sizes)

    return f"""
WITH docs AS (SELECT row_number() OVER () AS doc_row, doc_id, {tokens('text')} AS t FROM documents),
items AS (SELECT row_number() OVER () AS item, item_id, {tokens('text')} AS t FROM benchmark),
layout(length, start, size) AS (VALUES {', '.join(map(str, layout))}),
item_parts AS (
  SELECT item, start, size, array_to_string(t[start + 1:start + size], ' ') AS seed
  FROM items JOIN layout ON len(t) = length),
doc_seeds AS ({seeds('docs', 'doc_row')} UNION ALL {windows}),
item_seeds AS ({seeds('items', 'item')}
  UNION ALL SELECT item, {len(leaks.SEEDS)} + size AS mask, start AS pos, seed FROM item_parts),
aligned AS (
  SELECT DISTINCT d.doc_row, i.item, d.pos - i.pos AS shift
  FROM doc_seeds d JOIN item_seeds i ON d.mask = i.mask AND d.seed = i.seed),
laid AS (
  SELECT a.doc_row, a.item, shift, doc_id, item_id, d.t AS doc, i.t AS words, unnest(range(len(i.t))) AS place
  FROM aligned a JOIN docs d USING (doc_row) JOIN items i USING (item)),
equal AS (
  SELECT doc_row, item, shift, doc_id, item_id, len(words) AS length, place,
    row_number() OVER (PARTITION BY doc_row, item, shift ORDER BY place) AS nth
  FROM laid WHERE place + shift >= 0 AND doc[place + shift + 1] = words[place + 1]),
stretches AS (
  SELECT a.doc_row, a.item, a.shift, a.doc_id, a.item_id, a.length, a.place AS item_at,
    b.place - a.place + 1 AS n_tokens, b.nth - a.nth + 1 AS n_equal
  FROM equal a JOIN equal b ON a.doc_row = b.doc_row AND a.item = b.item AND a.shift = b.shift AND b.nth >= a.nth
  WHERE (b.place - a.place - (b.nth - a.nth)) * {leaks.TOLERANCE} <= b.place - a.place + 1
  QUALIFY row_number() OVER (PARTITION BY a.doc_row, a.item, a.shift ORDER BY b.place - a.place DESC, a.place, b.nth) = 1)
SELECT doc_id, item_id, item_at + shift AS doc_at, item_at, n_tokens, n_equal
FROM stretches WHERE n_tokens >= least({leaks.MIN_OVERLAP}, length)
QUALIFY row_number() OVER (PARTITION BY doc_row, item ORDER BY n_tokens DESC, n_equal DESC, item_at + shift, item_at) = 1"""


def _phrases() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    counted = " UNION ALL ".join(f"""
  SELECT lang, {size} AS length, array_to_string(w[pos:pos + {size - 1}], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) - {size - 2})) AS pos FROM pieces WHERE len(w) >= {size}) GROUP BY ALL"""
                               for size in range(1, phrases.LONGEST + 1))
    return f"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w
  FROM (SELECT coalesce(lang, '{phrases.NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
counted AS ({counted}),
frequent AS (SELECT lang, length, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= {phrases.LEAST}),
candidates AS (SELECT lang, length, phrase, f AS a, w FROM frequent WHERE length > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:length], ' ') AS tail
  FROM (SELECT *, unnest(range(1, length)) AS k FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, ({phrases.SCALE}::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = c.head
    JOIN frequent y ON y.lang = c.lang AND y.phrase = c.tail
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY {phrases.SCALE}::HUGEINT * c.a // (x.f + y.f), k) = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[pos:pos + size - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, length - size + 2)) AS pos
        FROM (SELECT *, unnest(range(2, length)) AS size FROM candidates WHERE length > 2)) GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
  s.phrase, a, l, r, n, score
FROM scored s LEFT JOIN inner_parts i ON i.lang = s.lang AND i.phrase = s.phrase JOIN totals t ON t.lang = s.lang
WHERE most IS NULL OR 100::HUGEINT * most < {phrases.COVERED}::HUGEINT * a
QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) <= {phrases.BEST}"""


def oracles() -> dict[str, str]:
    return {"op5_mixing": _mixing(), "op8_decontamination": _decontamination(), "op11_phrases": _phrases()}
