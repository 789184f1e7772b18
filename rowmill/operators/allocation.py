"""First-come allocation of limited stock and posting of transfers.

The rules are sequential: a request is judged after all earlier ones. They are
computed here without replaying a hot product or account in one task.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from rowmill.operators import joins
from rowmill.operators.components import components
from rowmill.operators.joins import skew_join
from rowmill.operators.ordered import names, number_rows, plan_slices, running_sums, sort_keys, totals
from rowmill.session import forget, materialize, settled

STEPS = 1000  # versions above a product's first one that get a folder of their own
FOLD_ROWS = 500_000  # open legs that are few enough for one task
STALLED = 3 / 4  # a bracket round that leaves more of the legs open than this is followed by a replay of components
NO_FLOOR = -(1 << 62)


def allocate(requests: DataFrame, stock: DataFrame, product: str, order: list[str], qty: str, level: str = "stock") -> DataFrame:
    """Add ``accepted``: a request is served if the stock left is at least its quantity; refused ones use nothing.

    ``stock`` has one row per product. Requests for an unknown product, and
    those whose quantity is NULL, zero or negative, are refused. Products with more requests than a task may take go
    through rounds; all others are served in tasks.
    """
    asked, requests = requests, requests.filter(F.col(qty) > 0)
    rows = skew_join(requests, stock.select(product, F.col(level).alias("_left")), [product], "left")
    rows = rows.withColumn("_left", F.coalesce(F.col("_left"), F.lit(0)).cast("bigint"))
    never = F.col(qty) > F.col("_left")  # what is left only falls
    out = [rows.filter(never).withColumn("accepted", F.lit(False))]
    rows, hot = _hot_products(rows.filter(~never), product)
    if hot is None:
        out.append(_allocate_in_tasks(rows, product, order, qty))
    else:
        out.append(_allocate_in_tasks(rows.join(F.broadcast(hot), product, "left_anti"), product, order, qty))
        out.append(_allocate_by_rounds(rows.join(F.broadcast(hot), product, "left_semi"), product, order, qty))
    out.append(asked.filter(~F.coalesce(F.col(qty) > 0, F.lit(False))).withColumn("accepted", F.lit(False)))
    return reduce(DataFrame.unionByName, [x.select(*asked.columns, "accepted") for x in out])


def _hot_products(rows: DataFrame, product: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows, products with more rows than a task may take, fewer than 1 / HOT_SHARE of them; None if there are none)."""
    if joins.is_small(rows):
        return rows, None
    rows = settled(rows)
    total, largest = joins.group_sizes(rows, [product])
    bound = max(joins.TASK_ROWS, int(total * joins.HOT_SHARE))
    if largest <= bound:
        return rows, None
    return rows, materialize(rows.groupBy(product).count().filter(F.col("count") > bound).select(product))


def _allocate_in_tasks(rows: DataFrame, product: str, order: list[str], qty: str) -> DataFrame:
    """Products that fit one task each: one pass over the sorted rows, batch by batch."""

    def serve(batches):
        current, left = None, 0
        for pdf in batches:
            accepted = []
            for key, need, start in zip(pdf[product].tolist(), pdf[qty].tolist(), pdf["_left"].tolist()):
                if key != current:
                    current, left = key, start
                take = need <= left
                left -= need if take else 0
                accepted.append(take)
            yield pdf.assign(accepted=pd.Series(accepted, index=pdf.index, dtype=bool))

    schema = StructType([*rows.schema.fields, StructField("accepted", BooleanType())])
    return rows.repartition(product).sortWithinPartitions(product, *sort_keys(order)).mapInPandas(serve, schema)


def _allocate_by_rounds(rows: DataFrame, product: str, order: list[str], qty: str) -> DataFrame:
    """Serve, in each round and for every product at once, the longest prefix that fits.

    What is left only falls, so a request above it is refused for good. The
    request that ends a prefix is one of these, so each round rules out at
    least one quantity value: there are at most as many rounds as distinct
    quantities.
    """
    done, stored = [], []
    pending = materialize(rows)
    while not pending.isEmpty():
        fits = F.col(qty) <= F.col("_left")
        done.append(pending.filter(~fits).withColumn("accepted", F.lit(False)))
        run = materialize(running_sums(pending.filter(fits), [product], order, {"_need": F.col(qty)}))
        stored += [pending, run]
        served = F.col("_need") <= F.col("_left")
        done.append(run.filter(served).drop("_need").withColumn("accepted", F.lit(True)))
        rest = run.filter(~served)
        used = rest.groupBy(product).agg(F.min(F.col("_need") - F.col(qty)).alias("_used"))
        rest = skew_join(rest, used, [product]).withColumn("_left", F.col("_left") - F.col("_used"))
        pending = materialize(rest.drop("_need", "_used"))
    if not done:
        return pending.withColumn("accepted", F.lit(False))
    whole = materialize(reduce(DataFrame.unionByName, done))
    for table in (*stored, pending):
        forget(table)
    return whole


def stock_after(stock: DataFrame, allocated: DataFrame, product: str, qty: str, level: str = "stock") -> DataFrame:
    used = allocated.filter("accepted").groupBy(product).agg(F.sum(qty).alias("_used"))
    return stock.join(used, product, "left").withColumn(level, F.col(level) - F.coalesce("_used", F.lit(0))).drop("_used")


def apply_versioned(stock: DataFrame, requests: DataFrame, product: str, order: str, qty: str, version: str = "version",
                    level: str = "stock") -> tuple[DataFrame, DataFrame]:
    """(stock after, applied requests) for version-checked updates.

    A request applies if its version equals the stored one and the stock
    covers it; that raises the version. Each round applies the first match of
    every product, so there are at most as many rounds as versions asked for.

    A product is in round r only if r requests of its were applied, so only requests r versions above its first one matter then. Requests are
    stored once, in a folder for each such distance (those from STEPS on share one); a round reads its own folder. Products without a match are done.
    """
    first = stock.select(product, F.col(version).cast("bigint").alias("_from"))
    asked = skew_join(requests.select(product, order, F.col(qty).alias("_qty"), F.col(version).alias("_version")), first, [product])
    asked = asked.withColumn("_ahead", F.col("_version") - F.col("_from")).filter("_ahead >= 0")
    asked = asked.select(product, order, "_qty", "_ahead", F.least("_ahead", F.lit(STEPS)).alias("_step"))
    wanted = materialize(asked, "_step")
    live = materialize(stock.select(product, F.col(version).cast("bigint").alias(version), F.col(level).cast("bigint").alias(level),
                                    F.lit(None).cast(requests.schema[order].dataType).alias("_last")))
    ended, applied, stored, step = [], [], [wanted, live], 0
    while True:
        now = requests_of_round(wanted, step)
        fits = (F.col("_qty") <= F.col(level)) & (F.col("_last").isNull() | (F.col(order) > F.col("_last")))
        hits = skew_join(now, live, [product]).filter(fits).groupBy(product).agg(F.min(F.struct(order, "_qty")).alias("_hit"))
        moved = materialize(live.join(hits, product, "left").select(product, version, level, F.col(f"_hit.{order}").alias(order), F.col("_hit._qty").alias("_qty")))
        stored.append(moved)
        ended.append(moved.filter("_qty IS NULL").select(product, version, level))
        if moved.filter("_qty IS NOT NULL").isEmpty():
            break
        applied.append(moved.filter("_qty IS NOT NULL").select(product, order))
        live = moved.filter("_qty IS NOT NULL").select(product, (F.col(version) + 1).alias(version), (F.col(level) - F.col("_qty")).alias(level), F.col(order).alias("_last"))
        step += 1
    after, done = materialize(reduce(DataFrame.unionByName, ended)), materialize(reduce(DataFrame.unionByName, applied, asked.select(product, order).limit(0)))
    for table in stored:
        forget(table)
    return after, done


def requests_of_round(wanted: DataFrame, step: int) -> DataFrame:
    return wanted.filter((F.col("_step") == min(step, STEPS)) & (F.col("_ahead") == step)).drop("_step", "_ahead")


def transfer_legs(transfers: DataFrame, source: str, target: str, amount: str) -> DataFrame:
    """Two rows per transfer: the debit leg (negative delta) and the credit leg."""
    legs = F.array(F.struct(F.col(source).alias("account"), F.lit("debit").alias("type"), (-F.col(amount)).alias("delta")),
                   F.struct(F.col(target).alias("account"), F.lit("credit").alias("type"), F.col(amount).alias("delta")))
    keep = [c for c in transfers.columns if c not in (source, target)]
    return transfers.select(*keep, F.explode(legs).alias("l")).select(*keep, "l.*")


def post_unchecked(legs: DataFrame, accounts: DataFrame, order: list[str], balance: str, floor: Column) -> DataFrame:
    """Post every leg, add ``balance_after`` and flag legs that leave the account below its floor."""
    rows, slices = _on_accounts(legs, accounts, "inner")
    rows = running_sums(rows, ["account"], order, {"_moved": F.col("delta")}, slices)
    after = F.col(balance) + F.col("_moved")
    return rows.withColumn("balance_after", after).withColumn("overdrawn", after < floor).drop("_moved")


def _on_accounts(legs: DataFrame, accounts: DataFrame, how: str) -> tuple[DataFrame, int | None]:
    """(legs with the columns of their account, 0 if each account fits a task, else None).

    Where each fits, the join and a window over accounts share one shuffle of the legs.
    """
    legs, slices = plan_slices(legs, ["account"])
    if slices:
        return skew_join(legs, accounts, ["account"], how), None
    return legs.join(joins.bounded_broadcast(accounts), "account", how).select(*legs.columns, *[c for c in accounts.columns if c != "account"]), 0


def _replay(legs: DataFrame, ident: str, order: list[str], group: str) -> DataFrame:
    """(ident, accepted) of open legs, request after request; each group, which shares no account with another, in one task."""
    here = legs.schema[ident]

    def judge(batches):
        current, now, parts, moved = None, None, [], {}

        def verdict():
            for account, delta, debit, room in parts:
                if debit < 0 and room + moved.get(account, 0) + debit < 0:
                    return False
            for account, delta, *_ in parts:
                moved[account] = moved.get(account, 0) + delta
            return True

        for pdf in batches:
            out = []
            for name, request, *leg in zip(*(pdf[c].tolist() for c in (group, ident, "account", "delta", "_debit", "_room"))):
                if parts and (request != now or name != current):
                    out.append((now, verdict()))
                    parts = []
                if name != current:
                    current, moved = name, {}
                now = request
                parts.append(leg)
            yield pd.DataFrame(out, columns=[ident, "accepted"])
        if parts:
            yield pd.DataFrame([(now, verdict())], columns=[ident, "accepted"])

    schema = StructType([here, StructField("accepted", BooleanType())])
    return legs.repartition(group).sortWithinPartitions(group, *sort_keys(order), "account").mapInPandas(judge, schema)


def _replay_apart(legs: DataFrame, ident: str, order: list[str]) -> DataFrame:
    """(ident, accepted) of the open legs, each component of the conflict graph (accounts linked by a request) in a task of its own.

    Of a component with more legs than a task may take, only its first requests are judged: they depend on nothing else.
    """
    least = legs.groupBy(ident).agg(F.min("account").alias("b"))
    links = skew_join(legs.select(ident, F.col("account").alias("a")), least, [ident]).filter("a <> b").select("a", "b").distinct()
    roots = components(links)
    named = skew_join(legs, roots.select(F.col("a").alias("account"), F.col("b").alias("_root")), ["account"], "left")
    named = materialize(named.withColumn("_root", F.coalesce("_root", "account")))
    forget(roots)
    sizes = named.groupBy("_root").agg(F.count("*").alias("_n"))
    big = materialize(sizes.filter(F.col("_n") > joins.TASK_ROWS).select("_root"))
    judged = _replay(named.join(big, "_root", "left_anti"), ident, order, "_root")
    if big.isEmpty():
        return judged
    placed = number_rows(named.join(big, "_root", "left_semi"), ["_root"], [*order, "account"], "_place")
    early = placed.groupBy(ident).agg(F.max("_place").alias("_place")).filter(F.col("_place") <= joins.TASK_ROWS).select(ident)
    return judged.unionByName(_replay(placed.join(early, ident, "left_semi").drop("_place"), ident, order, "_root"))


def settle(legs: DataFrame, balances: DataFrame, ident: str, order: list[str], balance: str, floor: str, active: str | None = None,
           trace: list[tuple[str, int]] | None = None) -> DataFrame:
    """Accept or refuse each request, a set of legs that stand or fall together, in order.

    A request is accepted if each account it debits stays at or above
    ``floor``, given the accepted earlier requests. Requests that touch an
    unknown account are refused, and so are those that touch an account whose
    column ``active`` is not true. ``ident`` names the request and ends ``order``.

    A bracket round bounds the balance before every open request between the
    outcomes where all, or none, of the open earlier debits happen (and the
    reverse for credits). Requests that pass even at the lower end are
    accepted, those that fail even at the upper end are refused; the rest stay
    open. The first open request has an exact balance, so every round makes
    progress. Only open legs, and newly accepted ones, are carried on, and of
    these only legs that a later undecided leg of their account can feel: a
    leg that passes at the lower end passes for good. A round shuffles them
    twice, by account and by request, and writes what is carried on. Open legs that one task may
    take (FOLD_ROWS) are judged one after another there. Where a round leaves
    more than STALLED of the legs open, the next one replays the components of
    their conflict graph, each in a task, instead.

    ``trace`` receives a line for each round: its kind, and the legs open after it.
    """
    if active is not None:
        balances = balances.filter(F.col(active))
    keys = names(order)
    moved = F.coalesce(F.sum("delta"), F.lit(0)).alias("delta")  # a null amount moves nothing
    net = legs.groupBy(*keys, "account").agg(moved, F.sum(F.least("delta", F.lit(0))).alias("_debit"))
    net = materialize(net)
    room = F.col(balance) - F.coalesce(F.col(floor), F.lit(NO_FLOOR))
    rows, slices = _on_accounts(net, balances.select("account", room.alias("_room")), "left")
    rows = rows.withColumn("_sure", F.lit(False))
    wide = plan_slices(net, [ident])[1] > 0  # a request may have more legs than a task takes
    done, stored, opened, kind = [], [net], net.count(), "bracket"
    trace = [] if trace is None else trace
    while True:
        run = running_sums(rows, ["account"], order, {
            "_at": F.lit(1),
            "_known": F.when(F.col("_sure"), F.col("delta")).otherwise(0),
            "_down": F.when(F.col("_sure"), 0).otherwise(F.least("delta", F.lit(0))),
            "_up": F.when(F.col("_sure"), 0).otherwise(F.greatest("delta", F.lit(0)))}, slices)
        still = run.filter(~F.col("_sure")).withColumns({
            "_room": F.col("_room") + F.col("_known"),
            "_down": F.col("_down") - F.least("delta", F.lit(0)), "_up": F.col("_up") - F.greatest("delta", F.lit(0))})
        carried = [*keys, "account", "delta", "_debit", "_room"]
        if trace and opened <= min(FOLD_ROWS, joins.TASK_ROWS):
            done.append(materialize(_replay(still.select(*carried, F.lit(0).alias("_root")), ident, order, "_root")))
            stored.append(done[-1])
            trace.append(("fold", 0))
            break
        if kind == "bracket":
            # A leg of an unknown account has no room and fails.
            safe = F.coalesce(F.when(F.col("_debit") < 0, F.col("_room") + F.col("_down") + F.col("_debit") >= 0).otherwise(F.col("_room").isNotNull()), F.lit(False))
            hopeless = F.coalesce((F.col("_debit") < 0) & (F.col("_room") + F.col("_up") + F.col("_debit") < 0), F.lit(False)) | F.col("_room").isNull()
            still = still.withColumns({"_safe": safe, "_hopeless": hopeless})
            # A slice of an account too large for a task does not see the legs behind it.
            felt = F.max(F.when(~F.col("_safe"), F.col("_at"))).over(Window.partitionBy("account")) if slices == 0 else F.col("_at")
            still = still.withColumn("_felt", F.coalesce(F.col("_at") <= felt, F.lit(False))).select(*carried, "_safe", "_hopeless", "_felt")
            if wide:
                still = materialize(still)  # totals reads it twice
                stored.append(still)
            leg = F.struct(*keys, "account")
            still = _of_request(still, ident, wide, {"_yes": F.bool_and("_safe"), "_no": F.bool_or("_hopeless"), "_lead": F.min(leg)})
            # One leg of each request carries its verdict.
            judged = still.select(*carried, F.when(F.col("_no"), False).when(F.col("_yes"), True).alias("accepted"),
                                  F.col("_lead").eqNullSafe(leg).alias("_lead"), (F.col("_felt") & ~F.col("_no")).alias("_kept"))
            judged = materialize(judged.filter("_kept OR (_lead AND accepted IS NOT NULL)"))
            done.append(judged.filter("_lead AND accepted IS NOT NULL").select(ident, "accepted").distinct())  # an account listed twice has its legs twice
            rows = judged.filter("_kept").select(*carried, F.col("accepted").isNotNull().alias("_sure"))
            stored.append(judged)
        else:
            still = materialize(still.select(*carried))
            verdict = materialize(_replay_apart(still, ident, order))
            done.append(verdict)
            rows = skew_join(still, verdict, [ident], "left", null_safe=True).filter("accepted IS NULL OR accepted")
            rows = materialize(rows.select(*carried, F.col("accepted").isNotNull().alias("_sure")))
            stored += [still, verdict, rows]
        before, opened = opened, rows.filter(~F.col("_sure")).count()
        trace.append((kind, opened))
        if not opened:
            break
        # A component round is followed by a bracket round: it may have left a request with more legs than a task takes.
        kind = "components" if kind == "bracket" and opened > STALLED * before else "bracket"
    whole = materialize(reduce(DataFrame.unionByName, done))
    for table in stored:
        forget(table)
    return whole


def _of_request(legs: DataFrame, ident: str, wide: bool, aggs: dict[str, Column]) -> DataFrame:
    """Add aggregates over all legs of the request; ``wide`` where one may have more legs than a task takes."""
    if wide:
        return totals(legs, [ident], aggs)
    return legs.withColumns({k: c.over(Window.partitionBy(ident)) for k, c in aggs.items()})
