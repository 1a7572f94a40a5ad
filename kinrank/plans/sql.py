"""SQL for the derived inputs and for the steps several oracles share."""

RATINGS = """
ratings AS (
  SELECT user_id, product_id, rating, ts_s FROM (
    SELECT user_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id,
           LEAST(5, 1 + CAST(floor(value / 25) AS INTEGER)) AS rating,
           CAST(floor(epoch(ts)) AS BIGINT) AS ts_s,
           row_number() OVER (
             PARTITION BY user_id, CAST(json_extract_string(props, '$.k') AS INTEGER)
             ORDER BY ts DESC, event_id DESC) AS latest
    FROM events) AS e
  WHERE latest = 1)"""

MARKS = """
marks AS (
  SELECT -1 - user_id AS user_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id,
         MAX(LEAST(5, CAST(floor(value / 25) AS INTEGER))) AS rating
  FROM events WHERE event_type = 'signup' GROUP BY 1, 2)"""

# the same, each day of a user a person of its own
DAILY_MARKS = """
daily_marks AS (
  SELECT -1 - (user_id * 100000 + CAST(floor(epoch(ts) / 86400) AS BIGINT)) AS user_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id,
         MAX(LEAST(5, CAST(floor(value / 25) AS INTEGER))) AS rating
  FROM events WHERE event_type = 'signup' GROUP BY 1, 2)"""

BASKETS = """
basket_items AS (
  SELECT DISTINCT l_orderkey AS order_id, p_brand AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# held-out tenths of the pairs, by the digit of the pair's hash
HASHED = """
hashed AS (
  SELECT *, (user_id * 7919 + product_id * 104729) % 1009 % 10 AS digit FROM ratings)"""


def similarities(mine: str, theirs: str) -> str:
    """``sims``: Pearson similarity of every pair of users with products in common."""
    return f"""
sums AS (
  SELECT a.user_id, b.user_id AS neighbour_id, count(*) AS n,
         sum(a.rating * 1.0::DOUBLE) AS sx, sum(b.rating * 1.0::DOUBLE) AS sy,
         sum(a.rating * a.rating * 1.0::DOUBLE) AS sxx,
         sum(b.rating * b.rating * 1.0::DOUBLE) AS syy,
         sum(a.rating * b.rating * 1.0::DOUBLE) AS sxy
  FROM {mine} AS a JOIN {theirs} AS b
    ON a.product_id = b.product_id AND a.user_id <> b.user_id
  GROUP BY a.user_id, b.user_id),
sims AS (
  SELECT user_id, neighbour_id, n,
         GREATEST(-1.0::DOUBLE, LEAST(1.0::DOUBLE,
           (n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)))) AS sim
  FROM sums WHERE n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0)"""


NEAREST = """
near AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY user_id ORDER BY sim DESC, neighbour_id) AS rank FROM sims) AS s
  WHERE rank <= 25)"""


def estimates(theirs: str) -> str:
    """``est``: the neighbours' weighted mean rating of every product they rated."""
    return f"""
bounds AS (SELECT min(rating) AS low, max(rating) AS high FROM {theirs}),
weighted AS (
  SELECT near.user_id, r.product_id, count(*) AS n,
         sum(sim * r.rating) AS num, sum(sim) AS den
  FROM near JOIN {theirs} AS r ON r.user_id = near.neighbour_id
  GROUP BY near.user_id, r.product_id),
est AS (
  SELECT user_id, product_id, n,
         round(GREATEST(LEAST(num / den, high), low), 6) AS score
  FROM weighted, bounds WHERE n >= 2 AND round(den, 9) <> 0)"""


def ranked(own: str) -> str:
    """``recs``: the ten best estimates of products not in ``own``."""
    return f"""
recs AS (
  SELECT user_id, pos, product_id, score FROM (
    SELECT est.user_id, est.product_id, est.score,
           row_number() OVER (PARTITION BY est.user_id
                              ORDER BY est.score DESC, est.product_id) AS pos
    FROM est ANTI JOIN {own} AS o
      ON o.user_id = est.user_id AND o.product_id = est.product_id) AS e
  WHERE pos <= 10)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
