"""DuckDB SQL for the operators whose results SQL expresses."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def mix_sql(docs: str, seed: str = "mix") -> str:
    """CTEs ending in ``mixed`` (doc_id, text, source, size, source_size,
    target, copies) over the relation ``docs`` (doc_id, text, source, ...)."""
    return rf"""
sized AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight,
         2.0::DOUBLE * source_size AS ceiling FROM per),
ranked AS (
  SELECT *, row_number() OVER o AS rank,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM per)
          - coalesce(sum(ceiling) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW o AS (ORDER BY ceiling / weight, source NULLS LAST)),
settled AS (SELECT min(rank) AS rank, arg_min(level, rank) AS level FROM ranked WHERE level * weight <= ceiling),
plan AS (
  SELECT r.source, r.source_size,
         CASE WHEN s.rank IS NULL OR r.rank < s.rank THEN r.ceiling ELSE s.level * r.weight END AS target
  FROM ranked r, settled s),
drawn AS (
  SELECT d.*, p.source_size, p.target, CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('{seed}:' || coalesce(d.doc_id::VARCHAR, '') || ':' || md5(coalesce(d.text, ''))), 1, 8))::BIGINT
           / 4294967296.0::DOUBLE AS draw
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
mixed AS (
  SELECT *, floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM drawn)"""


MIXTURE = f"""WITH {mix_sql('documents')}
SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"""


def hits_sql(docs: str) -> str:
    """CTEs ending in ``judged`` (n, n_words, n_hit, items) per numbered row of
    ``docs`` (n, doc_id, text)."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{word}')"
    return rf"""
item_words AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {words} AS w FROM benchmark),
item_at AS (
  SELECT item, w, least(len(w), 10) AS width, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS pos
  FROM item_words WHERE len(w) > 0),
item_window AS (SELECT DISTINCT item, width, array_to_string(w[pos + 1 : pos + width], ' ') AS win FROM item_at),
doc_words AS (SELECT n, {words} AS w FROM {docs}),
widths AS (SELECT DISTINCT width FROM item_window),
doc_at AS (
  SELECT n, w, width, unnest(range(0, len(w) - width + 1)) AS pos
  FROM doc_words, widths WHERE len(w) >= width),
doc_window AS (SELECT n, pos, width, array_to_string(w[pos + 1 : pos + width], ' ') AS win FROM doc_at),
hit AS (SELECT d.n, d.pos, d.width, i.item FROM doc_window d JOIN item_window i ON d.width = i.width AND d.win = i.win),
hit_words AS (
  SELECT n, count(DISTINCT p) AS n_hit
  FROM (SELECT n, unnest(range(pos, pos + width)) AS p FROM hit) GROUP BY n),
hit_items AS (SELECT n, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY n),
judged AS (
  SELECT d.n, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.items, []) AS items
  FROM doc_words d LEFT JOIN hit_words h USING (n) LEFT JOIN hit_items i USING (n))"""


DECONTAMINATION = f"""WITH numbered AS (SELECT row_number() OVER () AS n, doc_id, text FROM documents), {hits_sql('numbered')}
SELECT d.doc_id, j.n_words, j.n_hit, len(j.items)::BIGINT AS n_items,
       sha256(array_to_string(j.items, ',')) AS items_sha256, j.n_hit > 0 AS contaminated
FROM numbered d JOIN judged j USING (n)"""


def near_sql(docs: str, width: int = 10, slop: int = 2, missing: int = 1) -> str:
    """CTEs ending in ``judged`` (n, n_places, items) per numbered row of
    ``docs`` (n, doc_id, text)."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{word}')"
    return rf"""
item_words AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {words} AS w FROM benchmark),
item_at AS (SELECT item, w, unnest(range(0, greatest(len(w) - {width}, 0) + 1)) AS place FROM item_words WHERE len(w) > 0),
windows AS (
  SELECT row_number() OVER () AS id, win, items
  FROM (SELECT w[place + 1 : place + {width}] AS win, list(DISTINCT item) AS items FROM item_at GROUP BY win)),
doc_words AS (SELECT n, {words} AS w FROM {docs}),
doc_at AS (SELECT n, unnest(w) AS term, unnest(range(0, len(w))) AS pos FROM doc_words),
counted AS (SELECT term, count(*) AS tf FROM doc_at GROUP BY term),
placed AS (SELECT id, len(win) AS size, unnest(win) AS term, unnest(range(0, len(win))) AS place FROM windows),
probes AS (
  SELECT id, place, term, tf FROM placed LEFT JOIN counted USING (term)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY coalesce(tf, 0), term, place)
          <= 1 + CASE WHEN size = {width} THEN {missing} ELSE 0 END),
starts AS (SELECT DISTINCT d.n, p.id, d.pos - p.place AS start FROM probes p JOIN doc_at d USING (term)),
heard AS (
  SELECT s.n, s.id, s.start, v.items, len(v.win) AS size,
         list_sum([list_contains(t.w[greatest(s.start + i - {slop}, 0) + 1 : s.start + i + {slop} + 1], v.win[i + 1])::INT FOR i IN range(0, len(v.win))
                   IF s.start + i + {slop} >= 0]) AS found
  FROM starts s JOIN windows v USING (id) JOIN doc_words t USING (n)),
near AS (SELECT * FROM heard WHERE found >= size - CASE WHEN size = {width} THEN {missing} ELSE 0 END),
near_items AS (SELECT n, list_sort(list(DISTINCT item)) AS items FROM (SELECT n, unnest(items) AS item FROM near) GROUP BY n),
near_places AS (SELECT n, count(*) AS n_places FROM near GROUP BY n),
judged AS (
  SELECT d.n, coalesce(p.n_places, 0) AS n_places, coalesce(i.items, []) AS items
  FROM doc_words d LEFT JOIN near_places p USING (n) LEFT JOIN near_items i USING (n))"""


NEAR_PHRASES = f"""WITH numbered AS (SELECT row_number() OVER () AS n, doc_id, text FROM documents), {near_sql('numbered')}
SELECT d.doc_id, j.n_places, len(j.items)::BIGINT AS n_items, sha256(array_to_string(j.items, ',')) AS items_sha256
FROM numbered d JOIN judged j USING (n)"""


#: The reversed polynomial of CRC-32.
CRC_POLYNOMIAL = 0xEDB88320


def crc32_sql(text: str, step: str = "t") -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes, with the column ``entries``
    of ``crc_table``, its list of 256 numbers, in scope."""
    octets = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    folded = (
        f"list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
        f"lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))"
    )
    return f"xor({folded}, 4294967295::BIGINT)"


_bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, {p}) ELSE c >> 1 END"
CRC_TABLE = f"""
crc_steps(n, c, bit) AS (
  SELECT n, n, 0 FROM range(256) r(n)
  UNION ALL SELECT n, {_bit.format(p=CRC_POLYNOMIAL)}, bit + 1 FROM crc_steps WHERE bit < 8),
crc_table AS (SELECT list(c ORDER BY n) AS entries FROM crc_steps WHERE bit = 8)"""


def _leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


def _climb(name: str, start: str) -> str:
    """CTEs ``name`` (tree, level, pos, digest): the trees over ``start`` (tree,
    pos, digest)."""
    return f"""
{name}(tree, level, pos, digest, n) AS (
  SELECT tree, 0, pos, digest, count(*) OVER (PARTITION BY tree) FROM {start}
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY tree, pos // 16)"""


def _paths(name: str, nodes: str, start: str, first: str) -> str:
    """CTE ``name``: for every row of ``start`` (id, tree, pos, folded, proof)
    what it is and has been hashed with, up to the tree's root."""
    siblings = f"(SELECT string_agg(s.digest, '' ORDER BY s.pos) FROM {nodes} s WHERE s.tree = p.tree AND s.level = p.level AND s.pos // 16 = p.pos // 16 AND s.pos"
    elder, younger = f"coalesce({siblings} < p.pos), '')", f"coalesce({siblings} > p.pos), '')"
    return f"""
{name}(id, tree, level, pos, folded, proof) AS (
  SELECT id, tree, 0, pos, folded, {first} FROM {start}
  UNION ALL
  SELECT p.id, p.tree, p.level + 1, p.pos // 16, sha256({elder} || p.folded || {younger}), p.proof || {elder} || {younger}
  FROM {name} p WHERE EXISTS (SELECT 1 FROM {nodes} u WHERE u.tree = p.tree AND u.level = p.level + 1))"""


MERKLE = f"""WITH RECURSIVE {CRC_TABLE},
leaf AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '') AS tree, {_leaf('text')} AS digest,
         CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 5 = 0
              THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered
  FROM documents, crc_table),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM leaf),
{_climb('nodes', 'placed')},
sub AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM nodes WHERE n = 1),
groups AS (SELECT '' AS tree, pos, subroot AS digest FROM sub),
{_climb('tops', 'groups')},
start AS (SELECT id, tree, pos, coalesce(tampered, digest) AS folded FROM placed),
{_paths('within', 'nodes', 'start', "''")},
arrived AS (SELECT id, tree, folded, proof FROM within QUALIFY level = max(level) OVER (PARTITION BY id)),
again AS (SELECT a.id, '' AS tree, s.pos, a.folded, a.proof FROM arrived a JOIN sub s USING (tree)),
{_paths('across', 'tops', 'again', 'proof')},
ended AS (SELECT id, folded, proof FROM across QUALIFY level = max(level) OVER (PARTITION BY id)),
root AS (SELECT digest AS root FROM tops WHERE n = 1)
SELECT p.doc_id, p.digest AS leaf, s.subroot, r.root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
       e.folded = r.root AS verified
FROM placed p JOIN sub s USING (tree) JOIN ended e USING (id) CROSS JOIN root r"""


SPELLING = f"""WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\u00C0-\u00FF]+')) AS run
  FROM documents),
hashed AS (
  SELECT run, coalesce({crc32_sql("(doc_id::VARCHAR || ':' || run)")}, 1) AS h
  FROM runs, crc_table WHERE length(run) >= 6),
typed AS (
  SELECT CASE WHEN h % 199 = 0
              THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed),
words AS (SELECT word, count(*) AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
holes AS (
  SELECT word, n, place, left(word, place) || substr(word, place + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS place FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b USING (place, rest) WHERE a.word != b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS best, max(n) AS best_n FROM near GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk(word, root, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON w.form = f.word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM walk WHERE form IS NULL) USING (word)"""
