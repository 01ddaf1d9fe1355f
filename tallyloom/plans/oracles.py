"""The registry's results as plain SQL for DuckDB, written independently of the DataFrame code."""

from __future__ import annotations

WS = r"\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
LATIN = "a-zA-ZÀ-ÖØ-öø-ÿ"
LATIN_STOP = "'the','of','and','la','de','die','der','und','que','el'"
LETTERS, DEVANAGARI_LETTERS = "abcdefghijklmnopqrstuvwxyz", "रमकलछनयतपसहगदबजघचटडणथधफभवश"
NEPALI_STOP = ("'र','पनि','छ','छन्','हो','हुन्','भएको','गरेको','भने','गर्नु','तथा','गरेका','भनेका','यस','यो','त्यो',"
               "'मा','को','का','ले','लाई','देखि','बाट','सम्म','भनेर','पर्ने','पर्छ','हुने','हुन्छ'")
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
HREF = r"""(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']"""
SEQUENCE_BLANKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
SUMMARY = "trade_date, buyer_broker, seller_broker, symbol, total_volume, total_amount, trade_count"
TRADE = "contract_id, trade_date, symbol, buyer_broker, seller_broker, quantity, rate, total_amount"
ALERT = "alert_date, alert_type, broker_id, symbol, risk_score, details, is_reviewed"
CUT, SECOND = "DATE '1999-06-30'", "DATE '1999-01-01'"


def _hash(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8))::BIGINT"


TEST_LIMIT = int(0.2 * 2 ** 32)

TRADES = """trades AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS contract_id,
    CAST(l_shipdate AS DATE) AS trade_date, p_type AS symbol,
    CAST(o_custkey % 3 AS INTEGER) AS buyer_broker, CAST(l_suppkey % 3 AS INTEGER) AS seller_broker,
    CAST(l_quantity AS BIGINT) AS quantity,
    CAST(floor(l_extendedprice * 40 / l_quantity) AS DECIMAL(12,2)) AS rate,
    CAST(l_extendedprice * 40 AS DECIMAL(16,2)) AS total_amount,
    l_partkey, l_suppkey, l_discount, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

FIRST = TRADES + """, first_rows AS (
  SELECT * FROM (SELECT t.*, row_number() OVER (PARTITION BY contract_id, trade_date
    ORDER BY trade_date, l_partkey, l_suppkey, quantity, total_amount, l_discount, l_tax) AS rn FROM trades t) q
  WHERE rn = 1)"""

SILVER = FIRST + """, silver AS (SELECT * FROM first_rows WHERE quantity > 0 AND total_amount > 0)"""

FACT = SILVER + """, fact AS (
  SELECT trade_date, buyer_broker, seller_broker, upper(trim(symbol)) AS symbol,
    CAST(sum(quantity) AS BIGINT) AS total_volume, CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_amount,
    CAST(count(contract_id) AS INTEGER) AS trade_count
  FROM silver GROUP BY 1, 2, 3, 4)"""

PAIRS = FACT + """, pairs AS (
  SELECT p.trade_date, p.symbol, p.buyer_broker AS broker_a, p.seller_broker AS broker_b,
    p.total_volume AS volume_a_to_b, q.total_volume AS volume_b_to_a,
    p.total_volume + q.total_volume AS aggregate_matched_volume,
    CAST(p.total_amount + q.total_amount AS DECIMAL(19,2)) AS aggregate_matched_amount,
    p.trade_count + q.trade_count AS total_reciprocal_trades,
    CAST(least(p.total_volume, q.total_volume) AS DOUBLE) / CAST(greatest(p.total_volume, q.total_volume) AS DOUBLE) AS ratio
  FROM fact p JOIN fact q ON p.trade_date = q.trade_date AND p.symbol = q.symbol
    AND p.buyer_broker = q.seller_broker AND p.seller_broker = q.buyer_broker
  WHERE p.buyer_broker < p.seller_broker)"""

RISK = """CASE WHEN aggregate_matched_amount > 5000000 AND ratio > CAST(0.80 AS DOUBLE) THEN 'HIGH_SUSPICION_CIRCULAR_WASH'
    WHEN aggregate_matched_amount > 1000000 AND ratio > CAST(0.60 AS DOUBLE) THEN 'MEDIUM_SUSPICION_RECIPROCAL'
    ELSE 'LOW_RISK_MATCH' END"""

WASH = PAIRS + f""", wash AS (
  SELECT trade_date, symbol, broker_a, broker_b, aggregate_matched_volume, aggregate_matched_amount,
    total_reciprocal_trades, round(ratio, 4) AS volume_symmetry_ratio, {RISK} AS risk_classification
  FROM pairs WHERE aggregate_matched_amount >= 500000)"""

PAIR_ROWS = f"""WITH {PAIRS} SELECT trade_date, symbol, broker_a, broker_b, volume_a_to_b, volume_b_to_a,
  aggregate_matched_volume, aggregate_matched_amount, total_reciprocal_trades,
  round(ratio, 6) AS volume_symmetry_ratio FROM pairs"""

ALERTS = FACT + """, made AS (
  SELECT trade_date AS alert_date, 'SUSPICIOUS_VOLUME_SPIKE' AS alert_type, buyer_broker AS broker_id, symbol,
    CAST(0.95 AS DECIMAL(5,4)) AS risk_score,
    concat('Volume: ', CAST(total_volume AS VARCHAR), ' Amount: NRs.', CAST(total_amount AS VARCHAR)) AS details,
    FALSE AS is_reviewed
  FROM (SELECT *, row_number() OVER (PARTITION BY trade_date, buyer_broker, symbol
          ORDER BY total_amount DESC, seller_broker) AS rn FROM fact WHERE total_volume >= 60) f
  WHERE rn = 1)"""

FLAWED = TRADES + """, flawed AS (
  SELECT contract_id, trade_date, buyer_broker, seller_broker, rate,
    CASE WHEN l_partkey % 11 <> 0 THEN symbol END AS symbol,
    CASE WHEN l_suppkey % 13 = 0 THEN 0 WHEN l_suppkey % 17 <> 0 THEN quantity END AS quantity,
    CAST(CASE WHEN l_partkey % 19 = 0 THEN -total_amount ELSE total_amount END AS DECIMAL(16,2)) AS total_amount
  FROM trades)"""

FOREX = """forex AS (
  SELECT CAST(o_orderdate AS DATE) AS rate_date,
    concat('n', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS currency_iso3,
    min(n_name) AS currency_name, CAST(1 AS INTEGER) AS currency_unit,
    CAST(min(o_totalprice) AS DECIMAL(12,4)) AS buying_rate, CAST(max(o_totalprice) AS DECIMAL(12,4)) AS selling_rate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""

NEWS = """news AS (
  SELECT d.doc_id, d.text, d.source, CASE WHEN l.quality = 1 THEN 'Real' ELSE 'Fake' END AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

TEXTS = "news AS (SELECT doc_id, text, source FROM documents)"

RULED = NEWS + """, ruled AS (
  SELECT doc_id, label, CASE WHEN length(text) % 3 = 0 THEN 'Fake' ELSE 'Real' END AS prediction FROM news)"""

#: Report over a relation ``ruled`` of (label, prediction).
REPORT = """, per AS (
        SELECT c.label AS "class", count(*) FILTER (WHERE r.label = c.label AND prediction = c.label)::DOUBLE AS tp,
          count(*) FILTER (WHERE prediction = c.label)::DOUBLE AS guessed, count(*) FILTER (WHERE r.label = c.label) AS support
        FROM ruled r CROSS JOIN (SELECT unnest(['Fake', 'Real']) AS label) c GROUP BY c.label),
      scores AS (SELECT "class", CASE WHEN guessed > 0 THEN tp / guessed ELSE 0 END AS p,
        CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r,
        CASE WHEN guessed + support > 0 THEN 2 * tp / (guessed + support) ELSE 0 END AS f, support FROM per)
      SELECT "class", round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM scores
      UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM scores
      UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
        round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
      UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n FROM (
        SELECT avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0 END) AS a, count(*) AS n FROM ruled) q"""

RETAIL = """retail AS (
  SELECT l_orderkey, l_linenumber, CAST(p_partkey AS VARCHAR) AS item_identifier,
    CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS item_weight,
    CASE p_partkey % 5 WHEN 0 THEN 'LF' WHEN 1 THEN 'low fat' WHEN 2 THEN 'reg'
      WHEN 3 THEN 'Low Fat' ELSE 'Regular' END AS item_fat_content,
    l_discount AS item_visibility, p_retailprice AS item_mrp, CAST(l_suppkey AS VARCHAR) AS outlet_identifier,
    CAST(year(o_orderdate) AS INTEGER) AS outlet_establishment_year,
    CASE l_suppkey % 4 WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' END AS outlet_size,
    o_orderpriority AS outlet_location_type, l_returnflag AS outlet_type, l_extendedprice AS item_outlet_sales
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

FAT = "CASE item_fat_content WHEN 'LF' THEN 'Low Fat' WHEN 'low fat' THEN 'Low Fat' WHEN 'reg' THEN 'Regular' ELSE item_fat_content END"

# Text -------------------------------------------------------------------------------------------


def _clean(text: str, keep: str, drop: str, stop: str) -> str:
    kept = f"regexp_replace(coalesce({text}, ''), '[^{keep}{WS}]', '', 'g')"
    kept = f"regexp_replace({kept}, '[{drop}]', '', 'g')"
    squeezed = f"trim(regexp_replace({kept}, '[{WS}]+', ' ', 'g'))"
    return (f"array_to_string(list_filter(string_split({squeezed}, ' '), "
            f"lambda w: NOT list_contains([{stop}], w)), ' ')")


LATIN_CLEAN = _clean("text", LATIN, "0-9", LATIN_STOP)
NEPALI_CLEAN = _clean(f"translate(text, '{LETTERS}', '{DEVANAGARI_LETTERS}')", "ऀ-ॿ", "a-zA-Z0-9", NEPALI_STOP)
TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"

WORDS = NEWS + f""", words AS (SELECT doc_id, label, {TOKENS.format(LATIN_CLEAN)} AS w FROM news)"""


ALL_WORDS = f"""{TEXTS}, words AS (SELECT doc_id, CAST(NULL AS VARCHAR) AS label, {TOKENS.format(LATIN_CLEAN)} AS w FROM news)"""


def _grams(lo: int, hi: int) -> str:
    parts = []
    for n in range(lo, hi + 1):
        gram = "array_to_string(list_slice(w, i, i + {0}), ' ')".format(n - 1)
        parts.append(f"SELECT doc_id, label, {gram} AS term FROM (SELECT doc_id, label, w, "
                     f"unnest(generate_series(1, len(w) - {n - 1})) AS i FROM words WHERE len(w) >= {n})")
    return "grams AS (" + " UNION ALL ".join(parts) + ")"


def _tf(lo: int = 1, hi: int = 1, words: str = WORDS) -> str:
    return words + ", " + _grams(lo, hi) + """, tf AS (
      SELECT doc_id, label, term, count(*) AS tf FROM grams GROUP BY 1, 2, 3)"""


STATS = """, stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS freq FROM tf GROUP BY term)"""


def _weights(docs: str = "words", tf: str = "tf", keep: str = "SELECT term, df FROM stats", apply: str = "tf",
             out: str = "weights") -> str:
    return f""", n AS (SELECT count(*) AS n FROM {docs}), kept AS ({keep}),
  idf AS (SELECT term, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0 AS idf FROM kept, n),
  raw AS (SELECT doc_id, label, term, tf * idf AS v FROM {apply} JOIN idf USING (term)),
  {out} AS (SELECT doc_id, label, term, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def _model(docs: str = "words", weights: str = "weights") -> str:
    return f""", sums AS (SELECT term, sum(CASE WHEN label = 'Fake' THEN weight ELSE 0.0 END) AS f,
      sum(CASE WHEN label = 'Real' THEN weight ELSE 0.0 END) AS r FROM {weights} GROUP BY term),
  mass AS (SELECT count(*) AS v, sum(f) AS f_all, sum(r) AS r_all FROM sums),
  model AS (SELECT term, 'Fake' AS label, ln((f + 1.0) / (f_all + v)) AS log_prob FROM sums, mass
    UNION ALL SELECT term, 'Real', ln((r + 1.0) / (r_all + v)) FROM sums, mass),
  priors AS (SELECT label, ln(count(*)::DOUBLE / (SELECT count(*) FROM {docs})) AS log_prior FROM {docs} GROUP BY label)"""


NB_RESULT = """
  SELECT doc_id, min(CASE WHEN s = b THEN label END) AS prediction,
    round(100.0 * max(exp(s - b)) / sum(exp(s - b)), 4) AS confidence
  FROM joint JOIN best USING (doc_id) GROUP BY doc_id"""
#: As many labelled texts of each class as the smaller one has.
EVEN = f"""SELECT doc_id, label, w FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_hash('doc_id', 7)}, doc_id) AS rn FROM words) q
  WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM words GROUP BY label) r)"""


def _predict(cap: str = "SELECT term, df FROM stats", docs: str = "SELECT * FROM words") -> str:
    return f"""WITH {WORDS}, marked AS (SELECT *, {_hash('doc_id')} < {TEST_LIMIT} AS is_test FROM ({docs}) d),
  gram AS (SELECT doc_id, label, is_test, unnest(w) AS term FROM marked),
  counts AS (SELECT doc_id, label, is_test, term, count(*) AS tf FROM gram GROUP BY ALL),
  tf AS (SELECT * FROM counts WHERE NOT is_test), train AS (SELECT * FROM marked WHERE NOT is_test){STATS},
  n AS (SELECT count(*) AS n FROM train), kept AS ({cap}),
  idf AS (SELECT term, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0 AS idf FROM kept, n),
  raw AS (SELECT doc_id, label, is_test, term, tf * idf AS v FROM counts JOIN idf USING (term)),
  every AS (SELECT doc_id, label, is_test, term, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS weight FROM raw),
  weights AS (SELECT * FROM every WHERE NOT is_test){_model('train')},
  joint AS (SELECT m.doc_id, p.label, p.log_prior + coalesce(sum(e.weight * t.log_prob), 0) AS s
    FROM marked m CROSS JOIN priors p LEFT JOIN every e ON e.doc_id = m.doc_id
    LEFT JOIN model t ON t.term = e.term AND t.label = p.label WHERE m.is_test GROUP BY m.doc_id, p.label, p.log_prior),
  best AS (SELECT doc_id, max(s) AS b FROM joint GROUP BY doc_id)""" + NB_RESULT


CAPPED = "SELECT term, df FROM stats ORDER BY freq DESC, term LIMIT 5000"

# Lines and word sequences -----------------------------------------------------------------------

LINES = f"""turns AS (SELECT conv_id, turn, string_split(text, chr(10)) AS ls FROM conversations),
  lines AS (SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS line_no,
      list_filter(string_split(translate(lower(ls[i]), '{SEQUENCE_BLANKS}' || chr(9) || chr(10),
        repeat(' ', {len(SEQUENCE_BLANKS) + 2})), ' '), lambda x: x <> '') AS w
    FROM (SELECT *, unnest(generate_series(1, len(ls))) AS i FROM turns)),
  line_words AS (SELECT conv_id, turn, line_no, i AS pos, w[i] AS word
    FROM (SELECT *, unnest(generate_series(1, len(w))) AS i FROM lines))"""

VOCAB = LINES + """, ranked AS (
  SELECT word, freq, row_number() OVER (ORDER BY freq DESC, conv_id, turn, line_no, pos) AS word_id FROM (
    SELECT word, count(*) OVER (PARTITION BY word) AS freq, conv_id, turn, line_no, pos,
      row_number() OVER (PARTITION BY word ORDER BY conv_id, turn, line_no, pos) AS rn FROM line_words) q WHERE rn = 1),
  vocab AS (SELECT word, freq, CAST(word_id AS INTEGER) AS word_id FROM ranked)"""

PREFIXES = VOCAB + """, coded AS (SELECT conv_id, turn, line_no, list(word_id ORDER BY pos) AS ids
    FROM line_words JOIN vocab USING (word) GROUP BY ALL),
  prefixes AS (SELECT conv_id, turn, line_no, CAST(size AS INTEGER) AS size, list_slice(ids, 1, size) AS seq
    FROM (SELECT *, unnest(generate_series(2, len(ids))) AS size FROM coded WHERE len(ids) >= 2))"""

NEXT = LINES + """, pairs AS (SELECT w[i] AS word, w[i + 1] AS nxt
    FROM (SELECT w, unnest(generate_series(1, len(w) - 1)) AS i FROM lines WHERE len(w) >= 2)),
  follow AS (SELECT word, nxt FROM (SELECT word, nxt, row_number() OVER (PARTITION BY word ORDER BY count(*) DESC, nxt) AS rn
    FROM pairs GROUP BY word, nxt) q WHERE rn = 1),
  seeds AS (SELECT conv_id, turn, line_no, array_to_string(w[1:2], ' ') AS seed, w[least(2, len(w))] AS tail
    FROM lines WHERE len(w) >= 1)"""

#: Every word of the vocabulary scored after every seed, from counts of runs of 2 to 4 words.
KNESER_NEY = LINES + """, at2 AS (SELECT w[i] AS c, w[i + 1] AS x, count(*) AS n FROM (
      SELECT w, unnest(generate_series(1, len(w) - 1)) AS i FROM lines WHERE len(w) > 1) GROUP BY ALL),
  at3 AS (SELECT w[i] AS b, w[i + 1] AS c, w[i + 2] AS x FROM (
      SELECT w, unnest(generate_series(1, len(w) - 2)) AS i FROM lines WHERE len(w) > 2) GROUP BY ALL),
  at4 AS (SELECT w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, w[i + 3] AS x, count(*) AS n FROM (
      SELECT w, unnest(generate_series(1, len(w) - 3)) AS i FROM lines WHERE len(w) > 3) GROUP BY ALL),
  n1 AS (SELECT x, count(*) AS n FROM at2 GROUP BY 1),
  n2 AS (SELECT c, x, count(*) AS n FROM at3 GROUP BY ALL),
  n3 AS (SELECT b, c, x, count(*) AS n FROM at4 GROUP BY ALL),
  s2 AS (SELECT c, sum(n)::DOUBLE AS t, count(*) AS k FROM n2 GROUP BY ALL),
  s3 AS (SELECT b, c, sum(n)::DOUBLE AS t, count(*) AS k FROM n3 GROUP BY ALL),
  s4 AS (SELECT a, b, c, sum(n)::DOUBLE AS t, count(*) AS k FROM at4 GROUP BY ALL),
  p1 AS (SELECT x, n / (SELECT sum(n)::DOUBLE FROM n1) AS p FROM n1),
  seeds AS (SELECT conv_id, turn, line_no, array_to_string(w[1:3], ' ') AS seed, w[1:3] AS s FROM lines WHERE len(w) > 0),
  asked AS (SELECT DISTINCT s, CASE WHEN len(s) > 2 THEN s[len(s) - 2] END AS a, CASE WHEN len(s) > 1 THEN s[len(s) - 1] END AS b, s[len(s)] AS c FROM seeds),
  q2 AS (SELECT s, a, b, c, x, CASE WHEN t IS NULL THEN p ELSE greatest(coalesce(n2.n, 0) - 0.75, 0)::DOUBLE / t + 0.75::DOUBLE * k / t * p END AS p
    FROM asked CROSS JOIN p1 LEFT JOIN s2 USING (c) LEFT JOIN n2 USING (c, x)),
  q3 AS (SELECT s, a, b, c, x, CASE WHEN t IS NULL THEN p ELSE greatest(coalesce(n3.n, 0) - 0.75, 0)::DOUBLE / t + 0.75::DOUBLE * k / t * p END AS p
    FROM q2 LEFT JOIN s3 USING (b, c) LEFT JOIN n3 USING (b, c, x)),
  q4 AS (SELECT s, x, CASE WHEN t IS NULL THEN p ELSE greatest(coalesce(at4.n, 0) - 0.75, 0)::DOUBLE / t + 0.75::DOUBLE * k / t * p END AS p
    FROM q3 LEFT JOIN s4 USING (a, b, c) LEFT JOIN at4 USING (a, b, c, x)),
  top AS (SELECT s, x, p FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY round(p, 12) DESC, x) AS rn FROM q4) WHERE rn = 1)
  SELECT conv_id, turn, line_no, seed, x AS next_word, round(p, 9) AS prob FROM seeds LEFT JOIN top USING (s)"""
KNESER_NEY = "WITH " + KNESER_NEY

# Pages ------------------------------------------------------------------------------------------

NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "''", "nbsp": " ", "copy": "©", "reg": "®",
         "trade": "™", "middot": "·", "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘",
         "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "deg": "°", "euro": "€",
         "pound": "£", "yen": "¥", "cent": "¢", "sect": "§", "times": "×", "zwj": "‍", "zwnj": "‌",
         "shy": "­"}
SHOWN = r"""shown AS (SELECT page_id, url,
  regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g') AS html FROM {0})"""


def _decode(t: str, v: str = "e") -> str:
    name = f"regexp_extract({v}, '{ENTITY}', 1)"
    rest = f"substr({v}, length({name}) + 2)"
    known = " ".join(f"WHEN '{k}' THEN '{c}' || {rest}" for k, c in NAMED.items())
    number = (f"CASE WHEN lower(substr({name}, 2, 1)) = 'x' THEN chr(CAST('0x' || substr({name}, 3) AS INTEGER)) "
              f"ELSE chr(CAST(substr({name}, 2) AS INTEGER)) END")
    piece = (f"CASE WHEN {name} LIKE '#%' THEN {number} || {rest} ELSE CASE {name} {known} ELSE '&' || {v} END END")
    return (f"CASE WHEN contains({t}, '&') THEN string_split({t}, '&')[1] || "
            f"array_to_string(list_transform(string_split({t}, '&')[2:], lambda {v}: {piece}), '') ELSE {t} END")


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _node(t: str, strip: str, v: str = "e") -> str:
    if strip == "nodes":
        cut = f"regexp_replace({t}, '[{WS}]*<[^>]*>[{WS}]*', '', 'g')"
        return _strip(_decode(cut, v))
    text = _decode(f"regexp_replace({t}, '<[^>]*>', '', 'g')", v)
    return _strip(text) if strip == "trim" else text


def _tag(t: str, tag: str, strip: str) -> str:
    pattern = rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"
    return (f"CASE WHEN regexp_matches({t}, '{pattern}') THEN "
            + _node(f"regexp_extract({t}, '{pattern}', 1)", strip) + " END")


PARAGRAPHS = SHOWN + r""", cut AS (SELECT page_id, url, html, list_transform(
    regexp_split_to_array(html, '(?i)<p(?:\s[^>]*)?>')[2:],
    lambda q: regexp_split_to_array(q, '(?i)</p\s*>|</article\s*>')[1]) AS ps FROM shown)"""


def _body(strip: str, min_len: int | None = None, measure: str = "none") -> str:
    items = "ps" if min_len is None else f"list_filter(ps, lambda q: length({_node('q', measure, 'e')}) > {min_len})"
    return f"array_to_string(list_transform({items}, lambda q: {_node('q', strip, 'e')}), ' ')"


def _links(patterns: str = "TRUE") -> str:
    return f"""WITH {SHOWN.format('pages')}, found AS (
    SELECT page_id, list_transform(regexp_extract_all(html, '{HREF}', 1), lambda h: {_decode('h')}) AS hs FROM shown),
  placed AS (SELECT page_id, hs[i] AS link, i FROM (SELECT *, unnest(generate_series(1, len(hs))) AS i FROM found)),
  firsts AS (SELECT page_id, link, min(i) AS i FROM placed WHERE {patterns} GROUP BY page_id, link)
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, link FROM firsts"""


ARTICLES = f"""{PARAGRAPHS.format('pages')}, articles AS (
  SELECT page_id, url AS "URL", string_split(list_last(string_split(url, '//')), '/')[1] AS "Source",
    {_tag('html', 'h1', 'trim')} AS "Title", CAST(NULL AS VARCHAR) AS "Publish_Date", 'Real' AS "Label", ps FROM cut)"""

SAFE_TITLE = f"replace(replace(coalesce({_tag('html', 'h1', 'trim')}, ''), '&', '&amp;'), '<', '&lt;')"
LISTING = SHOWN.format("pages") + f""", titled AS (SELECT page_id, url, {SAFE_TITLE} AS safe FROM shown),
  entries AS (
    SELECT page_id, unnest(CASE page_id % 4 WHEN 0 THEN [0] WHEN 1 THEN [0, 1] WHEN 2 THEN [1] ELSE [0] END) AS pos, url, safe FROM titled),
  listing AS (
    SELECT page_id, CAST(pos AS INTEGER) AS pos,
      CASE WHEN page_id % 4 IN (0, 2) OR (page_id % 4 = 1 AND pos = 1) THEN {_strip(_decode('safe'))}
        ELSE CAST(page_id AS VARCHAR) END AS title,
      CASE WHEN page_id % 4 = 3 THEN 'https://unknown.example/none' ELSE url || '#claim' END AS link
    FROM entries)"""
ADDRESS = "regexp_replace(regexp_replace(trim({0}), '#.*$', ''), '/+$', '')"

ORACLES = {
    "f1_wash_trades": f"WITH {WASH} SELECT * FROM wash",
    "a1_forex_roundtrip": f"""WITH {FOREX} SELECT rate_date, upper(currency_iso3) AS currency_iso3, currency_name,
        currency_unit, buying_rate, selling_rate FROM forex
      UNION ALL SELECT rate_date, 'X' || substr(currency_iso3, 2, 2), currency_name, currency_unit, NULL, selling_rate
        FROM forex""",
    "a2_floorsheet_roundtrip": f"""WITH {TRADES}, kept AS (
        SELECT contract_id, trade_date, upper(symbol) AS symbol, buyer_broker, seller_broker, quantity, rate,
          total_amount, 'line ' || CAST(l_partkey AS VARCHAR) AS trade_time_str FROM trades WHERE quantity > 0 AND quantity <> 50)
      SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY contract_id, trade_date
        ORDER BY symbol, buyer_broker, seller_broker, quantity, total_amount, rate, trade_time_str) AS rn FROM kept) q WHERE rn = 1""",
    "a7_fact_for_day": f"""WITH {FACT} SELECT buyer_broker, seller_broker, symbol, total_volume, total_amount, trade_count
      FROM fact WHERE trade_date = DATE '1998-06-15'""",
    "a14_views": f"""WITH {WASH} SELECT symbol, risk_classification, count(*) AS pairs,
      CAST(sum(aggregate_matched_volume) AS BIGINT) AS volume FROM wash GROUP BY 1, 2""",
    "b1_forex_unnest": f"""WITH {FOREX}
      SELECT CAST(rate_date AS VARCHAR) AS raw_date, currency_iso3 AS iso3, currency_name AS name,
        CAST(buying_rate AS VARCHAR) AS buy, CAST(selling_rate AS VARCHAR) AS sell FROM forex
      UNION ALL SELECT CAST(rate_date AS VARCHAR), 'x' || substr(currency_iso3, 2, 2), currency_name, 'n/a',
        CAST(selling_rate AS VARCHAR) FROM forex
      UNION ALL SELECT CAST(rate_date AS VARCHAR), NULL, currency_name, '1', CAST(selling_rate AS VARCHAR) FROM forex
      UNION ALL SELECT CAST(rate_date AS VARCHAR), NULL, NULL, NULL, NULL FROM forex""",
    "b2_trades_unnest": f"""WITH {TRADES}, texts AS (SELECT CAST(trade_date AS VARCHAR) AS payload_date, contract_id,
        ' ' || lower(symbol) || ' ' AS symbol, CAST(quantity AS VARCHAR) || '.7' AS quantity, l_partkey % 3 AS kind,
        quantity = 50 AS hollow FROM trades)
      SELECT payload_date, contract_id, symbol, quantity FROM texts WHERE NOT hollow
      UNION ALL SELECT payload_date, contract_id, symbol, '1,200' FROM texts WHERE NOT hollow AND kind = 0
      UNION ALL SELECT payload_date, NULL, symbol, quantity FROM texts WHERE NOT hollow AND kind = 1
      UNION ALL SELECT payload_date, NULL, NULL, NULL FROM texts WHERE hollow""",
    "b8_staging": f"""WITH {SILVER} SELECT contract_id, trade_date, upper(trim(symbol)) AS symbol, buyer_broker,
      seller_broker, quantity, rate, total_amount FROM silver""",
    "b12_risk_tiers": f"WITH {PAIRS} SELECT trade_date, symbol, broker_a, broker_b, {RISK} AS risk_classification FROM pairs",
    "b13_label_filter": "SELECT text, lang AS label, 'Fake' AS assigned FROM documents WHERE lang = 'fr'",
    "b17_recode": f"""WITH {RETAIL} SELECT l_orderkey, l_linenumber, item_identifier, {FAT} AS item_fat_content,
      CAST(2026 - outlet_establishment_year AS INTEGER) AS outlet_years,
      CAST(CASE {FAT} WHEN 'Low Fat' THEN 0 WHEN 'Regular' THEN 1 END AS INTEGER) AS fat_code,
      CAST(CASE outlet_size WHEN 'Small' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS INTEGER) AS size_code
      FROM retail""",
    "c1_reciprocal_pairs": PAIR_ROWS,
    "c1b_reciprocal_pairs_agg": PAIR_ROWS,
    "c2_append_if_absent": f"""WITH {ALERTS} SELECT * REPLACE (broker_id = 1 AS is_reviewed) FROM made""",
    "c3_merge_upsert": f"""WITH {FACT} SELECT {SUMMARY.replace('total_volume',
        f'total_volume + CASE WHEN trade_date >= {SECOND} THEN 1 ELSE 0 END AS total_volume')} FROM fact""",
    "c4_incremental_slice": f"""WITH {FACT} SELECT {TRADE} FROM silver
      WHERE trade_date >= (SELECT max(trade_date) FROM fact WHERE trade_date <= {CUT})""",
    "c4_slice_with_lookback": f"""WITH {FACT} SELECT {TRADE} FROM silver
      WHERE trade_date >= (SELECT max(trade_date) - 30 FROM fact WHERE trade_date <= {CUT})""",
    "c5_claim_pages": f"""WITH {LISTING}, ps AS (SELECT page_id, list_transform(
          regexp_split_to_array(html, '(?i)<p(?:\\s[^>]*)?>')[2:],
          lambda q: regexp_split_to_array(q, '(?i)</p\\s*>|</article\\s*>')[1]) AS ps FROM shown),
        behind AS (SELECT {ADDRESS.format('url')} AS address, min(page_id) AS target FROM pages GROUP BY 1),
        texts AS (SELECT page_id AS target, {_body('nodes', 20)} AS body FROM ps)
      SELECT page_id, pos, link AS "URL", title AS "Title", body AS "Text", 'Fake' AS "Label"
      FROM listing JOIN behind ON {ADDRESS.format('link')} = address JOIN texts USING (target)""",
    "d1_broker_matrix": f"WITH {FACT} SELECT {SUMMARY} FROM fact",
    "d2_row_counts": f"WITH {RETAIL} SELECT count(*) AS rows FROM retail",
    "d3_value_counts": f"WITH {RETAIL} SELECT {FAT} AS item_fat_content, count(*) AS count FROM retail GROUP BY 1",
    "d4_null_counts": "WITH " + RETAIL + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM retail" for c in (
            "item_identifier", "item_weight", "item_fat_content", "item_visibility", "item_mrp", "outlet_identifier",
            "outlet_establishment_year", "outlet_size", "outlet_location_type", "outlet_type", "item_outlet_sales")),
    "d5_profile": "WITH " + RETAIL + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) AS rows FROM retail" for c, t in (
            ("item_identifier", "string"), ("item_weight", "double"), ("item_fat_content", "string"),
            ("item_visibility", "double"), ("item_mrp", "double"), ("outlet_identifier", "string"),
            ("outlet_establishment_year", "int"), ("outlet_size", "string"), ("outlet_location_type", "string"),
            ("outlet_type", "string"), ("item_outlet_sales", "double"))),
    "d6_impute": f"""WITH {RETAIL}, m AS (SELECT avg(item_weight) AS mean FROM retail),
        top AS (SELECT outlet_size AS size FROM retail WHERE outlet_size IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
      SELECT l_orderkey, l_linenumber, round(coalesce(item_weight, mean), 6) AS item_weight,
        coalesce(outlet_size, size) AS outlet_size, coalesce(outlet_size, 'Medium') AS outlet_size_const
      FROM retail, m, top""",
    "d9_class_sizes": f"""WITH {NEWS}, c AS (SELECT count(*) FILTER (WHERE label = 'Fake') AS "Fake",
        count(*) FILTER (WHERE label = 'Real') AS "Real" FROM news) SELECT *, least("Fake", "Real") AS smallest FROM c""",
    "d10_confusion": f"""WITH {RULED} SELECT label, count(*) FILTER (WHERE prediction = 'Fake') AS "Fake",
      count(*) FILTER (WHERE prediction = 'Real') AS "Real" FROM ruled GROUP BY label""",
    "d11_accuracy": f"WITH {RULED} SELECT round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS accuracy FROM ruled",
    "d12_class_report": f"WITH {RULED}{REPORT}",
    "d12_balanced_report": f"""{_predict(docs=EVEN)[:-len(NB_RESULT)]}, ruled AS (SELECT doc_id, label, prediction
      FROM ({NB_RESULT}) q JOIN words USING (doc_id)){REPORT}""",
    "d13_regression_report": f"""WITH {RETAIL}, e AS (SELECT item_outlet_sales AS y, item_outlet_sales - item_mrp * 10 AS e FROM retail)
      SELECT round(avg(e * e), 1) AS mse, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
        round(1.0 - avg(e * e) / var_pop(y), 6) AS r2 FROM e""",
    "d15_dedupe": f"WITH {FIRST} SELECT {TRADE} FROM first_rows",
    "d17_term_stats": f"WITH {_tf(1, 2, ALL_WORDS)}{STATS} SELECT term, df, freq FROM stats",
    "f2_head": f"WITH {TEXTS} SELECT doc_id, source, text FROM news ORDER BY doc_id LIMIT 5",
    "f3_first_links": _links() + " QUALIFY pos < 3",
    "f5_shuffle": f"WITH {TEXTS} SELECT doc_id, source, {_hash('doc_id')} AS place FROM news",
    "f6_top_terms": f"WITH {_tf(words=ALL_WORDS)}{STATS} SELECT term, df, freq FROM stats ORDER BY freq DESC, term LIMIT 500",
    "f7_top_class_terms": f"""WITH {_tf(1, 2)}{STATS}{_weights()}{_model()},
        r AS (SELECT term, label, round(log_prob, 6) AS log_prob FROM model)
      SELECT label, CAST(rank AS INTEGER) AS rank, term, log_prob FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY log_prob DESC, term) AS rank FROM r) q WHERE rank <= 20""",
    "g1_concat_frames": f"""WITH {NEWS} SELECT doc_id, source, label, CAST(NULL AS INTEGER) AS n_chars FROM news WHERE label = 'Real'
      UNION ALL SELECT doc_id, NULL, label, CAST(length(text) AS INTEGER) FROM news WHERE label = 'Fake'""",
    "h11_clean_text": f"""WITH {TEXTS} SELECT doc_id, regexp_replace(text, '[^{LATIN}{WS}]', '', 'g') AS basic,
      {LATIN_CLEAN} AS cleaned FROM news""",
    "h11_clean_devanagari": f"SELECT doc_id, {NEPALI_CLEAN} AS cleaned FROM documents",
    "m1_clean_text_sql": f"SELECT doc_id, {NEPALI_CLEAN} AS cleaned FROM documents",
    "h16_url_host": """SELECT page_id, string_split(list_last(string_split(url, '//')), '/')[1] AS host,
      string_split(url, '.')[2] AS portal, contains(url, '/en/') OR contains(url, '/de/') AS listed FROM pages""",
    "h21_details": f"""WITH {FACT} SELECT trade_date, buyer_broker, seller_broker, symbol,
      strftime(trade_date, '%Y/%m/%d') AS folder,
      concat('Volume: ', CAST(total_volume AS VARCHAR), ' Amount: NRs.', CAST(total_amount AS VARCHAR)) AS details FROM fact""",
    "h24_prefix": f"WITH {TEXTS} SELECT doc_id, substr(text, 1, 50) AS prefix FROM news",
    "i3_tokens": f"""WITH {TEXTS}, t AS (SELECT doc_id, {TOKENS.format('text')} AS w FROM news)
      SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, w[i] AS token FROM (SELECT *, unnest(generate_series(1, len(w))) AS i FROM t)""",
    "i4_ngrams": f"WITH {_tf(1, 3, ALL_WORDS)} SELECT doc_id, term, tf FROM tf",
    "i5_tfidf": f"""WITH {_tf(words=ALL_WORDS)}{STATS}{_weights(keep="SELECT term, df FROM stats WHERE df <= CAST(0.7 AS DOUBLE) * (SELECT count(*) FROM words)")}
      SELECT doc_id, term, round(weight, 6) AS weight FROM weights""",
    "i5_tfidf_capped": f"""WITH {_tf(1, 3, ALL_WORDS)}{STATS}{_weights(keep=CAPPED)}
      SELECT doc_id, term, round(weight, 6) AS weight FROM weights""",
    "i6_split": f"WITH {NEWS} SELECT doc_id, label, CASE WHEN {_hash('doc_id')} < {TEST_LIMIT} THEN 'test' ELSE 'train' END AS part FROM news",
    "i6_split_exact": f"""WITH {NEWS} SELECT doc_id, label, CASE WHEN row_number() OVER (ORDER BY {_hash('doc_id')}, doc_id)
      <= ceil((SELECT count(*) FROM news) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM news""",
    "i7_balance": f"""WITH {NEWS}, ranked AS (SELECT doc_id, source, label,
        row_number() OVER (PARTITION BY label ORDER BY {_hash('doc_id')}, doc_id) AS rn FROM news),
      s AS (SELECT min(c) AS n FROM (SELECT count(*) AS c FROM news GROUP BY label) q)
      SELECT doc_id, source, label FROM ranked, s WHERE rn <= n""",
    "i8_nb_model": f"WITH {_tf()}{STATS}{_weights()}{_model()} SELECT term, label, round(log_prob, 6) AS log_prob FROM model",
    "i8_nb_priors": f"WITH {_tf()}{STATS}{_weights()}{_model()} SELECT label, round(log_prior, 6) AS log_prior FROM priors",
    "i9_nb_predict": _predict(),
    "i9_nb_predict_capped": _predict(CAPPED),
    "i13_label_encode": "WITH " + RETAIL + " SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, 'nan')) - 1 AS INTEGER) AS {c}" for c in (
            "item_fat_content", "outlet_location_type", "outlet_size", "outlet_type", "item_identifier",
            "outlet_identifier")) + " FROM retail",
    "i18_alerts": f"WITH {ALERTS} SELECT {ALERT} FROM made",
    "i19_open_alerts": f"WITH {ALERTS} SELECT {ALERT} FROM made WHERE broker_id <> 1",
    "i20_vocabulary": f"WITH {VOCAB} SELECT word, freq, word_id FROM vocab",
    "i21_prefixes": f"""WITH {PREFIXES} SELECT conv_id, turn, line_no, size, seq[1] AS first_id,
      md5(array_to_string(seq, ' ')) AS seq FROM prefixes""",
    "i22_padded": f"""WITH {PREFIXES}, m AS (SELECT max(size) AS m FROM prefixes)
      SELECT conv_id, turn, line_no, size, CAST(m - 1 AS INTEGER) AS width,
        md5(repeat('0 ', m - size) || array_to_string(list_slice(seq, 1, size - 1), ' ')) AS x, seq[size] AS y FROM prefixes, m""",
    "i23_next_words": f"""WITH {NEXT} SELECT conv_id, turn, line_no, seed,
        concat_ws(' ', seed, a.nxt, b.nxt, c.nxt, d.nxt) AS continued
      FROM seeds LEFT JOIN follow a ON a.word = tail LEFT JOIN follow b ON b.word = a.nxt
        LEFT JOIN follow c ON c.word = b.nxt LEFT JOIN follow d ON d.word = c.nxt""",
    "i23_kneser_ney": KNESER_NEY,
    "j1_title": f"WITH {SHOWN.format('pages')} SELECT page_id, coalesce({_tag('html', 'h1', 'trim')}, 'No Title') AS title FROM shown",
    "j1_title_nodes": f"WITH {SHOWN.format('pages')} SELECT page_id, {_tag('html', 'h1', 'nodes')} AS title FROM shown",
    "j2_body": f"WITH {PARAGRAPHS.format('pages')} SELECT page_id, {_body('none')} AS body FROM cut",
    "j2_body_portal": f"WITH {PARAGRAPHS.format('pages')} SELECT page_id, {_body('trim', 20, 'trim')} AS body FROM cut",
    "j2_body_site": f"WITH {PARAGRAPHS.format('pages')} SELECT page_id, {_body('nodes', 30)} AS body FROM cut",
    "j3_keep": f"""WITH {ARTICLES}, t AS (SELECT page_id, "Title" AS title, {_body('nodes', 30)} AS body FROM articles)
      SELECT page_id, CAST(length(body) AS INTEGER) AS n_chars FROM t WHERE title <> '' AND length(body) > 3000""",
    "j4_links": _links("contains(link, '/th') OR contains(link, '/en') OR contains(link, '/de') OR contains(link, '/la')"),
    "j5_claim_listing": f"WITH {LISTING} SELECT page_id, pos, title, link FROM listing",
    "j6_articles": f"""WITH {ARTICLES} SELECT page_id, "URL", "Source", "Title", {_body('trim', 20, 'trim')} AS "Text",
      "Publish_Date", "Label" FROM articles""",
    "k1_not_null": "WITH " + FLAWED + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS violations FROM flawed"
        for c in ("contract_id", "symbol", "quantity", "trade_date")),
    "k2_rules": "WITH " + FLAWED + " " + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {c}) AS violations FROM flawed" for n, c in (
            ("quantity_positive", "quantity <= 0"), ("rate_not_negative", "rate < 0"),
            ("amount_not_negative", "total_amount < 0"), ("contract_id_length", "length(contract_id) > 64"),
            ("symbol_length", "length(symbol) > 20"))),
    "k2_forex_rules": f"WITH {FOREX}, n AS (SELECT *, day(rate_date) AS d FROM forex) " + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {c}) AS violations FROM n" for n, c in (
            ("unit_positive", "d = 7"), ("buying_rate_not_negative", "d = 11 AND buying_rate > 0"),
            ("selling_rate_not_negative", "d = 13 AND selling_rate > 0"), ("iso3_length", "d = 3"),
            ("name_length", "d = 5 AND length(currency_name) > 5"))),
    "k2_alert_rules": f"WITH {ALERTS} " + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {c}) AS violations FROM made" for n, c in (
            ("score_in_range", "day(alert_date) < 10"), ("type_length", "day(alert_date) % 3 = 0"), ("symbol_length", "length(symbol) > 10"))),
    "k3_unique": f"WITH {TRADES} SELECT contract_id, trade_date, count(*) AS rows FROM trades GROUP BY 1, 2 HAVING count(*) > 1",
    "k3_unique_contract": f"WITH {TRADES} SELECT contract_id, count(*) AS rows FROM trades GROUP BY 1 HAVING count(*) > 1",
    "k4_quarantine": f"""WITH {FLAWED}, r AS (SELECT contract_id, trade_date, total_amount, concat_ws(',',
        CASE WHEN symbol IS NULL THEN 'symbol_missing' END, CASE WHEN quantity IS NULL THEN 'quantity_missing' END,
        CASE WHEN quantity <= 0 THEN 'quantity_positive' END, CASE WHEN rate < 0 THEN 'rate_not_negative' END,
        CASE WHEN total_amount < 0 THEN 'amount_not_negative' END, CASE WHEN length(contract_id) > 64 THEN 'contract_id_length' END,
        CASE WHEN length(symbol) > 20 THEN 'symbol_length' END) AS reasons FROM flawed)
      SELECT contract_id, trade_date, total_amount, reasons FROM r WHERE reasons <> ''""",
    "l2_refresh_fact": f"""WITH {FACT}, last AS (SELECT max(trade_date) AS day FROM fact WHERE trade_date <= {CUT})
      SELECT {SUMMARY.replace('total_volume', 'total_volume * CASE WHEN trade_date < day THEN 10 ELSE 1 END AS total_volume')}
      FROM fact, last""",
    "l4_first_run": f"WITH {FACT} SELECT {SUMMARY} FROM fact",
}
