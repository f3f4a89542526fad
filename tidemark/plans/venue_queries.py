"""Queries of venue payloads: payloads as each venue would send them, made from the tables, read back, and held against the values themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import views as V
from tidemark.plans.catalogue import query
from tidemark.sources import catalogues as K
from tidemark.sources import venues as S

READ = [*S.POSITIVE, *S.NON_NEGATIVE, *S.ANY_NUMBER, *S.WHOLE]
_KEY = "p_partkey"
#: Parts whose rows are one payload.
PAYLOAD = 512


def _number(k: int):
    """A field's value, as what makes the column and in SQL; some are 0 or below."""
    return lambda: (F.col(_KEY) * (k + 3) % 97) / 4 - 2, f"(({_KEY} * {k + 3} % 97) / 4 - 2)"


def _whole(k: int):
    return lambda: F.lit(1_700_000_000_000) + F.col(_KEY) * (k + 3) % 97, f"(1700000000000 + {_KEY} * {k + 3} % 97)"


def _row(fields: dict, positional: bool, symbol, extra: dict | None = None):
    """JSON of one row: keys with values, or with arrays and objects for values in them."""
    keyed: dict = {}
    for at, value in [*fields.items(), *(extra or {}).items()]:
        key, inner = at if isinstance(at, tuple) else (at, None)
        if inner is None:
            keyed[key] = value
        else:
            keyed.setdefault(key, {})[inner] = value
    if positional:
        cells = dict(keyed) | symbol
        return F.to_json(F.array(*[F.coalesce(cells[i].cast("string"), F.lit("0")) if i in cells else F.lit("0") for i in range(max(cells) + 1)]))

    def cell(v):
        if not isinstance(v, dict):
            return v.cast("string")
        if all(isinstance(i, int) for i in v):
            return F.array(*[v[i].cast("string") if i in v else F.lit("0") for i in range(max(v) + 1)])
        return F.struct(*[x.cast("string").alias(str(i)) for i, x in v.items()])

    return F.to_json(F.struct(*[cell(v).alias(str(k)) for k, v in (symbol | keyed).items()]))


def _payloads(parts, feed, fields: dict, extra: dict | None = None):
    """Payloads of a feed's shape, each with the rows of PAYLOAD parts, so that more parts make more payloads and no larger ones."""
    name = F.concat(F.lit("S"), F.col(_KEY))
    own = {feed.symbol: name} if feed.symbol is not None and feed.shape != "parallel" else {}
    row = _row(fields, feed.shape == "arrays", own, extra)
    row = F.concat(F.lit('"'), name, F.lit('":'), row) if feed.shape == "map" else row
    listed = lambda c: F.array_join(F.collect_list(c), ",")
    if feed.shape == "parallel":
        names = F.to_json(F.struct(name.alias(feed.symbol)))
        made = parts.groupBy(F.floor(F.col(_KEY) / PAYLOAD).alias("file")).agg(F.array_sort(F.collect_list(F.struct(F.col(_KEY).alias("k"), names.alias("n"), row.alias("r")))).alias("rows"))
        body = F.concat(F.lit('[{"universe":['), F.array_join(F.transform("rows", lambda x: x["n"]), ","), F.lit("]},["), F.array_join(F.transform("rows", lambda x: x["r"]), ","), F.lit("]]"))
        return made.select(body.alias("payload"))
    made = parts.groupBy(F.floor(F.col(_KEY) / PAYLOAD).alias("file")).agg(listed(row).alias("rows"))
    body = F.concat(F.lit("{" if feed.shape == "map" else "["), "rows", F.lit("}" if feed.shape == "map" else "]"))
    steps = [x for x in feed.path.replace("[0]", ".[0]").split(".")[1:]]
    for step, above in reversed(list(zip(steps, ["$", *steps], strict=False))):
        beside = "".join(f',"{path.split(".")[-1]}":1700000000123' for path in feed.parent.values() if path.count(".") > 1 and path.split(".")[-2] == above)
        body = F.concat(F.lit("["), body, F.lit("]")) if step == "[0]" else F.concat(F.lit('{"' + step + '":'), body, F.lit(beside + "}"))
    top = [path[2:] for path in feed.parent.values() if path.count(".") == 1]
    if top:
        body = F.concat(F.substring(body, 1, 1), F.lit("".join(f'"{key}":1700000000123,' for key in top)), F.substr(body, F.lit(2)))
    return made.select(body.alias("payload"))


def _melted(df, numbers, texts=()):
    """(product, symbol, field, number, text): one row for each value that is there."""
    cells = [F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("number"), F.lit(None).cast("string").alias("text")) for c in numbers] + [F.struct(F.lit(c).alias("field"), F.lit(None).cast("double").alias("number"), F.col(c).cast("string").alias("text")) for c in texts]
    return df.select("product", "symbol", F.explode(F.array(*cells)).alias("c")).select("product", "symbol", "c.field", F.when(F.abs("c.number") > 1e9, F.col("c.number")).otherwise(F.round("c.number", 6)).alias("number"), "c.text").filter("number is not null or text is not null")


def _ticker_columns(feed):
    """By payload key, the column that stands there; by field, its SQL and test."""
    keys, told = {}, {}
    for k, name in enumerate(READ):
        scale = feed.scale.get(name, 1)
        if name in feed.constants:
            told[name] = (str(feed.constants[name]), "true")
        elif name in feed.fields:
            column, sql = (_whole if name in S.WHOLE else _number)(k)
            keys[feed.fields[name]] = column
            test = f"{sql} > 0" if name in S.POSITIVE else f"{sql} >= 0" if name in S.NON_NEGATIVE else "true"
            told[name] = (f"{sql} * {scale}" if scale != 1 else sql, test)
        elif name in feed.parent:
            told[name] = ("1700000000123", "true")
    seen: dict = {}
    for name in READ:  # fields that share a key have the value of the last
        if name in feed.fields:
            seen[feed.fields[name]] = name
    for name in READ:
        if name in feed.fields and seen[feed.fields[name]] != name:
            _, sql = (_whole if seen[feed.fields[name]] in S.WHOLE else _number)(READ.index(seen[feed.fields[name]]))
            told[name] = (sql, f"{sql} > 0" if name in S.POSITIVE else f"{sql} >= 0" if name in S.NON_NEGATIVE else "true")
    return keys, told


_CELL = "SELECT '{product}' AS product, {symbol} AS symbol, '{field}' AS field, {number} AS number, ({text})::VARCHAR AS text FROM part WHERE {test}"


def _exact(name: str, sql: str) -> str:
    """Times are whole; rounding them as numbers with decimals would change them."""
    return f"({sql})::DOUBLE" if name in S.WHOLE or name in K.TIMES else f"round(({sql})::DOUBLE, 6)"


def _ticker_sql(feed):
    _, told = _ticker_columns(feed)
    symbol = "'S' || p_partkey"
    cells = [_CELL.format(product=feed.product, symbol=symbol, field=n, number=_exact(n, v), text="NULL", test=t) for n, (v, t) in told.items()]
    return cells + [_CELL.format(product=feed.product, symbol=symbol, field=n, number="NULL", text=f"'{feed.constants[n]}'", test="true") for n in ("open_interest_unit", "funding_semantics") if n in feed.constants]


def _tickers(spark, sf_dir, feed):
    keys = {k: make() for k, make in _ticker_columns(feed)[0].items()}
    raw = S.raw(_payloads(V.table(spark, sf_dir, "part"), feed, keys), feed.venue, feed.product)
    return _melted(raw, READ, ("open_interest_unit", "funding_semantics"))


# --- catalogues: every word that a venue knows, and one that it does not


def _catalogue_columns(c):
    keys, told = {}, {}
    choice = lambda words: (lambda: F.element_at(F.array(*map(F.lit, words)), (1 + F.col(_KEY) % len(words)).cast("int")), f"[{', '.join(repr(w) for w in words)}][1 + {_KEY} % {len(words)}]")
    for k, name in enumerate((*K.WORDS, *K.TEXTS, *K.NUMBERS, *K.TIMES, "funding_semantics", "open_interest_unit")):
        if name in c.constants:
            told[name] = (repr(c.constants[name]), "true")
        elif name in c.fields:
            key = c.fields[name]
            if name in c.words or name in K.WORDS:
                words = [*c.words.get(name, {}), "odd"]
                column, sql = choice(words)
                if key in keys and name == "contract_type":
                    words = [*c.words["instrument_type"], "odd"]
                    column, sql = choice(words)
                table_ = c.words.get(name, {})
                keys[key] = column
                told[name] = ("[" + ", ".join(repr(table_.get(w, w)) for w in words) + f"][1 + {_KEY} % {len(words)}]", "true")
            elif name in K.TEXTS:
                keys[key] = lambda name=name: F.when(F.col(_KEY) % 5 > 0, F.concat(F.lit(name[:2].upper()), F.col(_KEY) % 7)).otherwise(F.lit(""))
                told[name] = (f"'{name[:2].upper()}' || ({_KEY} % 7)", f"{_KEY} % 5 > 0")
            elif name in K.TIMES:
                column, sql = _whole(k)
                keys[key] = lambda column=column: F.when(F.col(_KEY) % 3 > 0, column()).otherwise(F.lit(0))
                told[name] = (sql, f"{_KEY} % 3 > 0")
            else:
                column, sql = _number(k)
                keys[key] = column
                scale = c.scale.get(name, 1)
                told[name] = (f"{sql} * {scale!r}" if scale != 1 else sql, f"{sql} > 0" if name != "strike" else "true")
    return keys, told


def _catalogue_sql(c):
    _, told = _catalogue_columns(c)
    symbol = "'A' || p_partkey || '-B'" if c.pair == "symbol" else "'S' || p_partkey"
    if c.fields.get("base") == c.symbol:
        told["base"] = (symbol, "true")
    if c.pair is not None:
        told |= {"base": (f"'A' || {_KEY}" if c.pair == "symbol" else f"'PA' || ({_KEY} % 4)", "true"), "quote": ("'B'" if c.pair == "symbol" else "'QU'", "true")}
    if c.venue == "krakenfutures":
        told["instrument_type"] = (f"CASE WHEN {_KEY} % 3 > 0 THEN 'future' ELSE 'perpetual' END", "true")
    numeric = {*K.NUMBERS, *K.TIMES}
    cells = [_CELL.format(product=c.product, symbol=symbol, field=n, number=_exact(n, v) if n in numeric else "NULL", text="NULL" if n in numeric else v, test=t) for n, (v, t) in told.items()]
    good = "true" if c.active is None else f"{_KEY} % 4 > 0"
    return [*cells, _CELL.format(product=c.product, symbol=symbol, field="active", number="NULL", text=f"CASE WHEN {good} THEN 'true' ELSE 'false' END", test="true")]


def _catalogue(spark, sf_dir, c):
    keys, extra = {k: make() for k, make in _catalogue_columns(c)[0].items()}, {}
    if c.active is not None:
        bad = "false" if c.active[1][0] == "true" else "true" if c.active[1][0] == "false" else "gone"
        extra[c.active[0]] = F.when(F.col(_KEY) % 4 > 0, c.active[1][-1]).otherwise(bad)
    if c.pair not in (None, "symbol"):
        extra[c.pair] = F.concat(F.lit("PA"), F.col(_KEY) % 4, F.lit("/QU"))
    parts = V.table(spark, sf_dir, "part")
    if c.pair == "symbol":  # the symbol itself is the pair
        text = F.concat(F.lit("A"), F.col(_KEY), F.lit("-B"))
        row = _row(keys, False, {} if c.symbol is None else {c.symbol: text}, extra)
        row = F.concat(F.lit('"'), text, F.lit('":'), row) if c.shape == "map" else row
        body = F.concat(F.lit("{" if c.shape == "map" else "["), F.array_join(F.collect_list(row), ","), F.lit("}" if c.shape == "map" else "]"))
        for step in reversed(c.path.split(".")[1:]):
            body = F.concat(F.lit('{"' + step + '":'), body, F.lit("}"))
        payloads = parts.groupBy(F.floor(F.col(_KEY) / PAYLOAD).alias("file")).agg(body.alias("payload")).select("payload")
    else:
        keys.pop(c.symbol, None)
        payloads = _payloads(parts, c, keys, extra)
    made = K.catalogue(payloads, c.venue, c.product).withColumn("active", F.col("active").cast("string"))
    return _melted(made, (*K.NUMBERS, *K.TIMES), (*K.WORDS, *K.TEXTS, "funding_semantics", "open_interest_unit", "active"))


# --- books: each supplier and year is a symbol, with its line items as levels

_LEVELS = "lv AS (SELECT 'S' || l_suppkey || 'Y' || year(l_shipdate) AS symbol, CASE WHEN l_linestatus = 'O' THEN 'bid' ELSE 'ask' END AS side, l_extendedprice - 2000 AS price, l_quantity - 2 AS size FROM lineitem)"


def _clock(feed) -> int:
    """The time that the venue's books are of, in its own precision."""
    return 1_700_000_000_123 // feed.time_ms * feed.time_ms


def _books(spark, sf_dir, feed):
    l = V.table(spark, sf_dir, "lineitem").withColumn("symbol", F.concat(F.lit("S"), "l_suppkey", F.lit("Y"), F.year("l_shipdate")))  # noqa: E741
    p, s = (F.col("l_extendedprice") - 2000).cast("string"), (F.col("l_quantity") - 2).cast("string")
    level = F.to_json(F.array(p, s)) if isinstance(feed.price, int) else F.to_json(F.struct(p.alias(feed.price), s.alias(feed.size)))
    side = lambda status: F.concat(F.lit("["), F.array_join(F.collect_list(F.when(F.col("l_linestatus") == status, level)), ","), F.lit("]"))
    texts = l.groupBy("symbol").agg(side("O").alias("bids"), side("F").alias("asks"))

    def at(path):  # steps of a path, with levels of arrays as [0]
        return path.replace("$", "").replace("[", ".[").strip(".").split(".")

    tree: dict = {}
    for path, leaf in ((feed.bids, "BIDS"), (feed.asks, "ASKS"), *([(feed.time, "TIME")] if feed.time else [])):
        node, steps = tree, at(path)
        for step in steps[:-1]:
            node = node.setdefault(step, {})
        node[steps[-1]] = leaf

    def body(node):
        if not isinstance(node, dict):
            return {"BIDS": F.col("bids"), "ASKS": F.col("asks"), "TIME": F.lit(str(_clock(feed) // feed.time_ms))}[node]
        if all(k.startswith("[") for k in node):
            return F.concat(F.lit("["), F.concat_ws(",", *[body(node[k]) for k in sorted(node)]), F.lit("]"))
        return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{"PAIR" if k == "*" else k}":'), body(v)) for k, v in node.items()]), F.lit("}"))

    payloads = texts.select("symbol", body(tree).alias("payload"))
    found = K.book(payloads, feed.venue, 20)
    best = lambda c: F.get(F.col(c), F.lit(0))["price"]
    total = lambda c: F.round(F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x["price"] * x["size"]), 2)
    m = found.withColumns({"product": F.lit("book"), "best_bid": best("bids"), "best_ask": best("asks"), "n_bids": F.size("bids"), "n_asks": F.size("asks"), "bid_value": total("bids"), "ask_value": total("asks"), "cut": F.col("truncated").cast("string")})
    return _melted(m, ("best_bid", "best_ask", "n_bids", "n_asks", "bid_value", "ask_value", "event_ms"), ("cut",))


def _book_sql(feed):
    time = str(_clock(feed)) if feed.time else "NULL"
    return f"""SELECT 'book' AS product, symbol, field, round(number, 6) AS number, text FROM (SELECT symbol, unnest(['best_bid', 'best_ask', 'n_bids', 'n_asks', 'bid_value', 'ask_value', 'event_ms', 'cut']) AS field, unnest([bb, ba, nb, na, vb, va, {time}, NULL]::DOUBLE[]) AS number, unnest([NULL, NULL, NULL, NULL, NULL, NULL, NULL, cut]) AS text FROM (
SELECT symbol, max(price) FILTER (side = 'bid' AND k <= 20) AS bb, min(price) FILTER (side = 'ask' AND k <= 20) AS ba, count(*) FILTER (side = 'bid' AND k <= 20) AS nb, count(*) FILTER (side = 'ask' AND k <= 20) AS na, round(coalesce(sum(price * size) FILTER (side = 'bid' AND k <= 20), 0), 2) AS vb, round(coalesce(sum(price * size) FILTER (side = 'ask' AND k <= 20), 0), 2) AS va, CASE WHEN max(k) > 20 THEN 'true' ELSE 'false' END AS cut
FROM (SELECT *, CASE WHEN price > 0 AND size > 0 THEN row_number() OVER (PARTITION BY symbol, side, price > 0 AND size > 0 ORDER BY CASE side WHEN 'bid' THEN -price ELSE price END, CASE side WHEN 'bid' THEN -size ELSE size END) END AS k FROM lv) GROUP BY symbol)) WHERE number IS NOT NULL OR text IS NOT NULL"""


def _venue(slug: str):
    feeds, cats, book = [f for f in S.FEEDS if f.venue == slug], [c for c in K.CATALOGUES if c.venue == slug], K.BOOK_BY_VENUE.get(slug)
    cells = [f"SELECT 'tickers' AS source, * FROM ({' UNION ALL '.join(x for f in feeds for x in _ticker_sql(f))})"]
    cells += [f"SELECT 'catalogue' AS source, * FROM ({' UNION ALL '.join(x for c in cats for x in _catalogue_sql(c))})"] if cats else []
    cells += [f"SELECT 'book' AS source, * FROM ({_book_sql(book)})"] if book else []
    sql = f"WITH {_LEVELS} " + " UNION ALL ".join(cells)

    def read(spark, sf_dir):
        parts = [_tickers(spark, sf_dir, f).select(F.lit("tickers").alias("source"), "*") for f in feeds] + [_catalogue(spark, sf_dir, c).select(F.lit("catalogue").alias("source"), "*") for c in cats] + ([_books(spark, sf_dir, book).select(F.lit("book").alias("source"), "*")] if book else [])
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    read.__doc__ = f"Every value of {slug}'s tickers, derivatives, catalogue and books, read back from payloads."
    query(sql, f"venue_{slug}")(read)


for _slug in dict.fromkeys(f.venue for f in S.FEEDS):
    _venue(_slug)


@query("SELECT * FROM (VALUES ('bitmex', 'disabled', 'market data is not open to this collector', 0::BIGINT)) AS t(venue, status, reason, rows)")
def venue_disabled(spark, sf_dir):
    """Venues that are closed to us: a row that says so, and no data."""
    return S.disabled_health(spark)


@query("""WITH t AS (SELECT p_partkey % 3 AS v, 'S' || p_partkey AS symbol, ['USD', 'EUR', 'USDT', 'BTC'][1 + p_partkey % 4] AS base, ['USD', 'EUR', 'BTC'][1 + p_partkey % 3] AS quote, p_retailprice / 1000 AS last, CASE WHEN p_size % 2 = 0 THEN p_retailprice / 1001 END AS bid, CASE WHEN p_size % 3 > 0 THEN p_retailprice / 999 END AS ask FROM part)
SELECT symbol, base AS from_symbol, quote AS to_symbol, round(coalesce((bid + ask) / 2, last), 9) AS rate, CASE WHEN bid IS NOT NULL AND ask IS NOT NULL THEN 'mid' ELSE 'last' END AS source FROM t WHERE base IN ('USD', 'EUR', 'USDT') AND quote IN ('USD', 'EUR', 'USDT')""")
def venue_fx_records(spark, sf_dir):
    """Rates between currencies from a venue's own markets."""
    k, size, p = F.col(_KEY), F.col("p_size"), F.col("p_retailprice")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (1 + k % len(values)).cast("int"))
    parts = V.table(spark, sf_dir, "part")
    name = F.concat(F.lit("S"), k).alias("symbol")
    tickers = parts.select(F.lit("x").alias("venue"), name, (p / 1000).alias("last_price"), F.when(size % 2 == 0, p / 1001).alias("bid_price"), F.when(size % 3 > 0, p / 999).alias("ask_price"), F.lit(None).cast("long").alias("event_ms"))
    instruments = parts.select(name, F.lit("spot").alias("instrument_type"), pick(["USD", "EUR", "USDT", "BTC"]).alias("base"), pick(["USD", "EUR", "BTC"]).alias("quote"))
    return K.fx_records(tickers, instruments, ["USD", "EUR", "USDT"]).select("symbol", "from_symbol", "to_symbol", F.round("rate", 9).alias("rate"), "source")


@query("""WITH p AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'LONG' || s_nationkey || ':USD' ELSE chr(65 + (s_suppkey % 5)::INT) || 'BCUST' END AS pair, s_suppkey FROM supplier)
SELECT s_suppkey, 't' || pair AS symbol, CASE WHEN contains(pair, ':') THEN split_part(pair, ':', 1) WHEN substr(pair, 1, 3) = 'ABC' THEN 'XABC' ELSE substr(pair, 1, 3) END AS base, CASE WHEN contains(pair, ':') THEN 'USD' ELSE 'USDT' END AS quote, CASE WHEN substr(pair, 1, 3) = 'BBC' THEN 'B Coin' END AS base_name FROM p""")
def venue_renamed_codes(spark, sf_dir):
    """Pairs as texts, codes that the venue renames and names in tables of its own."""
    s = V.table(spark, sf_dir, "supplier")
    pair = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("LONG"), "s_nationkey", F.lit(":USD"))).otherwise(F.concat(F.char((65 + F.col("s_suppkey") % 5)), F.lit("BCUST")))
    codes = spark.createDataFrame([("UST", "USDt"), ("ABC", "xabc")], "code string, symbol string")
    names = spark.createDataFrame([("BBC", "B Coin")], "code string, name string")
    rows = s.select("s_suppkey", pair.alias("pair"))
    found = K.listed_pairs(rows.select("pair").distinct(), codes, names)
    return rows.join(found, F.col("symbol") == F.concat(F.lit("t"), "pair")).select("s_suppkey", "symbol", "base", "quote", "base_name")


@query("""WITH v AS (SELECT l_suppkey % 16 AS venue, count(*) AS rows, count(*) FILTER (l_quantity > 30 + l_suppkey % 16) AS priced, max(l_linenumber) * (1 + (l_suppkey % 16) // 2) AS requests, l_suppkey % 16 % 5 = 0 AS failed FROM lineitem GROUP BY 1, 5)
SELECT venue, CASE WHEN failed AND rows = 0 THEN 'failed' WHEN failed THEN 'degraded' WHEN rows = 0 THEN 'unavailable' WHEN priced / rows < 0.25 THEN 'degraded' WHEN requests > 40 THEN 'degraded' ELSE 'success' END AS status FROM v""")
def venue_health(spark, sf_dir):
    """How each venue's run went, in a word."""
    l, v = V.table(spark, sf_dir, "lineitem"), F.col("l_suppkey") % 16  # noqa: E741
    g = l.groupBy(v.alias("venue")).agg(F.count("*").alias("rows"), F.count_if(F.col("l_quantity") > 30 + v).alias("priced"), F.max("l_linenumber").alias("lines"))
    return g.select("venue", S.health(F.col("rows"), F.col("priced"), F.col("lines") * (1 + F.floor(F.col("venue") / 2)), F.col("venue") % 5 == 0).alias("status"))
