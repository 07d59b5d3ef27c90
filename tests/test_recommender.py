"""Recommendations against a brute-force ranking."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.operators import blocked, hybrid, recommender
from tastegraph.operators.ranking import first_rows
from tastegraph.session import ship_package


@pytest.fixture(scope="module")
def store(spark):
    ship_package(spark)
    games = spark.range(40).select(
        F.col("id").alias("game_id"),
        (F.col("id") % 11).cast("double").alias("normalized_score"),
        F.expr("transform(sequence(0, cast(id % 4 as int)), i -> concat('t', (id * 7 + i * i) % 9))").alias("categories"),
        F.lit(3).cast("long").alias("occurrence"),
        F.lit(1.0).alias("score"),
    )
    # User 0 owns a third of everything; user 9 has played nothing known.
    plays = [(0, g, 1.0 + g) for g in range(0, 40, 3)]
    plays += [(u, (u * 5 + i * i) % 40, float(u + i)) for u in range(1, 9) for i in range(4)]
    plays.append((9, 999, 5.0))
    playtimes = spark.createDataFrame(plays, "user_id long, game_id long, playtime_forever double")
    playtimes = playtimes.groupBy("user_id", "game_id").agg(F.max("playtime_forever").alias("playtime_forever"))
    reviews = spark.createDataFrame(
        [(i, i % 38, f"game {i % 38} v{i // 38}") for i in range(100)], "review_id long, app_id long, app_name string"
    )
    return games.select("game_id", "categories"), playtimes, games, reviews


def brute_force(store, k, threshold):
    tags, playtimes, games, reviews = store
    tag_of = {r.game_id: r.categories for r in tags.collect()}
    played = [(r.user_id, r.game_id, r.playtime_forever) for r in playtimes.collect()]
    expected = {}
    for user in {p[0] for p in played}:
        profile, total = {}, 0.0
        for _, game, time in (p for p in played if p[0] == user):
            for tag in tag_of.get(game, []):
                profile[tag] = profile.get(tag, 0.0) + time
                total += time
        owned = {p[1] for p in played if p[0] == user}
        scores = []
        for g in games.collect():
            if g.normalized_score > threshold and g.game_id not in owned:
                raw = sum(profile.get(t, 0.0) for t in g.categories) / (total or 1)
                scores.append((-round(raw / (1 + len(g.categories)), 12), g.game_id))
        for position, (score, game) in enumerate(sorted(scores)[:k]):
            expected[user, position] = (game, -score)
    return expected


@pytest.mark.parametrize("rows", [blocked.ITEM_ROWS, 40, 15])
def test_recommend_equals_brute_force(store, rows):
    best = recommender.recommend(*store, k=5, threshold=2.0, item_rows=rows).collect()
    found = {(r.user_id, r.position): (r.game_id, pytest.approx(r.predicted_score)) for r in best}
    assert found == brute_force(store, 5, 2.0)
    names = {r.game_id: r.app_name for r in best}
    assert all(name == (f"game {g} v0" if g < 38 else None) for g, name in names.items())


def test_default_cut(store):
    best = recommender.recommend(*store).collect()
    assert best and all(r.normalized_score > 9 for r in best)


def test_pair_scores_equal_one_user_scores(store):
    tags, playtimes, games, _ = store
    shares = recommender.user_features(recommender.user_category_profile(tags, playtimes))
    total = shares.groupBy("user_id").agg(F.sum("weight").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in total)
    one = {r.game_id: r.predicted_score for r in recommender.predict_for_user(0, shares, games).collect()}
    pairs = recommender.interactions(playtimes, games).filter("user_id = 0")
    for row in recommender.content_scores(pairs, shares, games).collect():
        assert one[row.game_id] == pytest.approx(row.predicted_score)
    assert len(one) == 40


def test_item_features_sum_to_one(store):
    weights = recommender.item_features(store[2]).groupBy("game_id").agg(F.sum("weight").alias("s"))
    assert all(r.s == pytest.approx(1.0) for r in weights.collect())


def test_zero_playtime_gives_zero_shares(spark):
    profile = spark.createDataFrame([(1, "a", 0.0)], "user_id long, category string, user_category_score double")
    assert recommender.user_features(profile).first().weight == 0.0


@pytest.mark.parametrize("scorer", ["als", "fm"])
@pytest.mark.parametrize("rows", [blocked.ITEM_ROWS, 7])
def test_trained_scorers_rank_unplayed_games(store, scorer, rows):
    tags, playtimes, games, reviews = store
    options = {"rank": 3, "max_iter": 3} if scorer == "als" else {"factors": 3, "epochs": 2}
    best = recommender.recommend(*store, k=6, threshold=2.0, scorer=scorer, item_rows=rows, **options).collect()
    owned = {(r.user_id, r.game_id) for r in playtimes.collect()}
    rankable = {g.game_id for g in games.collect() if g.normalized_score > 2.0}
    assert all((r.user_id, r.game_id) not in owned and r.normalized_score > 2.0 for r in best)
    by_user = {}
    for r in best:
        by_user.setdefault(r.user_id, []).append((r.position, r.game_id, r.predicted_score))
    assert set(by_user) == {u for u, _ in owned}
    for user, found in by_user.items():
        found.sort()
        assert [p for p, *_ in found] == list(range(min(6, len(rankable - {g for u, g in owned if u == user}))))
        assert [(-s, g) for _, g, s in found] == sorted((-s, g) for _, g, s in found)


def test_unknown_scorer_is_refused(store):
    with pytest.raises(ValueError, match="scorer"):
        recommender.recommend(*store, scorer="guess")


def test_vector_ranking_equals_brute_force(spark, monkeypatch):
    """Ties, owned games, users and games without vectors, blocks smaller than the tables."""
    monkeypatch.setattr(blocked, "CELLS", 50)
    rng = np.random.default_rng(3)
    users = {u: rng.integers(-2, 3, 4).astype(float) for u in range(23)}
    items = {g: rng.integers(-2, 3, 4).astype(float) for g in range(0, 60, 2)}
    owned = {(int(u), int(g)) for u, g in rng.integers(0, 61, (300, 2)) if u < 25} | {(0, g) for g in range(58)}
    frame = lambda rows, key: spark.createDataFrame([(k, v.tolist()) for k, v in rows.items()], f"{key} long, vector array<double>")
    games = spark.range(0, 64, 2).withColumnRenamed("id", "game_id")
    pairs = spark.createDataFrame([*owned, *list(owned)[:5]], "user_id long, game_id long").repartition(3)
    want = {}
    for u in set(users) | {u for u, _ in owned}:
        scores = [(-float(users[u] @ items[g]) if u in users and g in items else 0.0, g) for g in range(0, 64, 2) if (u, g) not in owned]
        want[u] = sorted(scores)[:5]
    for rows in (1000, 4):
        got = {}
        for r in recommender.top_vector_items(frame(users, "user_id"), frame(items, "game_id"), pairs, games, 5, rows).collect():
            got.setdefault(r.user_id, []).append((-r.predicted_score, r.game_id))
        assert {u: sorted(found) for u, found in got.items()} == want


def _tastes(spark, seed=0):
    """Users who mostly play games of hidden groups that cut across tags."""
    rng = np.random.default_rng(seed)
    tag_of = [f"t{g % 6}" for g in range(60)]
    group = rng.integers(0, 4, 60)
    plays = []
    for user in range(120):
        liked = np.flatnonzero(group == user % 4)
        plays += [(user, int(g), float(rng.integers(5, 50))) for g in rng.choice(liked, 8, replace=False)]
        plays += [(user, int(g), 1.0) for g in rng.choice(60, 1)]
    rows = spark.createDataFrame(plays, "user_id long, game_id long, playtime_forever double")
    rows = rows.groupBy("user_id", "game_id").agg(F.max("playtime_forever").alias("playtime_forever"))
    games = spark.createDataFrame([(g, [tag_of[g]], 10.0, 1.0) for g in range(60)], "game_id long, categories array<string>, normalized_score double, score double")
    return rows, games, group


@pytest.mark.parametrize("entities", [1 << 17, 40])
def test_hybrid_beats_content_on_held_out_pairs(spark, entities):
    """In one block and in several, which train side by side round after round."""
    rows, games, group = _tastes(spark)
    held = F.pmod(F.xxhash64("user_id", "game_id"), F.lit(5)) == 0
    known, hidden = rows.where(~held), rows.where(held & (F.col("playtime_forever") > 1))
    pairs = recommender.interactions(known, games)
    shares = recommender.user_features(recommender.user_category_profile(games.select("game_id", "categories"), known))
    model = recommender.train_hybrid(pairs, shares, games, factors=6, epochs=4, block_entities=entities)
    open_pairs = spark.createDataFrame([(u, g) for u in range(120) for g in range(60)], "user_id long, game_id long")
    open_pairs = open_pairs.join(known, ["user_id", "game_id"], "left_anti")
    good = {(r.user_id, r.game_id) for r in hidden.collect()}

    def auc(scores):
        ranked = sorted((r.predicted_score, (r.user_id, r.game_id) in good) for r in scores.collect())
        places = [i for i, (_, hit) in enumerate(ranked) if hit]
        return (sum(places) - len(places) * (len(places) - 1) / 2) / (len(places) * (len(ranked) - len(places)))

    ours, content = auc(model.predict(open_pairs)), auc(recommender.content_scores(open_pairs, shares, games))
    assert ours > 0.8 and ours > content + 0.1


def test_chunk_steps_go_down_the_gradient():
    """The loss of the chunk falls, own and tag vectors both move."""
    rng = np.random.default_rng(4)
    side = lambda n: hybrid.Side(np.arange(n), [rng.integers(0, 5, 2) for _ in range(n)], [rng.random(2) for _ in range(n)], [None] * n, 4, 1)
    users, games = side(20), side(15)
    tags = tuple(hybrid.Tags(rng.normal(0, 0.1, (5, 4)), np.zeros((5, 4))) for _ in range(2))
    user, game = rng.integers(0, 20, 400), rng.integers(0, 15, 400)
    label, weight = (user % 3 == game % 3).astype(float), rng.random(400) * 2

    def loss():
        u, g = users.vectors(user, tags[0].values), games.vectors(game, tags[1].values)
        score = (u[:, :-1] * g[:, :-1]).sum(axis=1) + u[:, -1] + g[:, -1]
        return float((weight * (np.logaddexp(0, score) - label * score)).sum())

    before, old = loss(), (users.own.copy(), tags[0].values.copy())
    hybrid.train_chunk(users, games, tags, (user, game, label, weight), 40, 0.1)
    assert loss() < before / 2 and not np.allclose(users.own, old[0]) and not np.allclose(tags[0].values, old[1])


def test_samples_weigh_playtime_and_avoid_played_pairs(store):
    _, playtimes, games, _ = store
    pairs = recommender.interactions(playtimes, games)
    samples = hybrid.weighted_samples(pairs, games)
    assert samples.where("label = 0").join(pairs, ["user_id", "game_id"], "left_semi").isEmpty()
    positive = samples.where("label = 1").agg(F.avg("weight"), F.count("*")).first()
    assert positive[0] == pytest.approx(1.0) and positive[1] == pairs.count()


def test_als_gives_k_games_per_user(store):
    _, playtimes, games, _ = store
    model, users, items = recommender.train_als(recommender.interactions(playtimes, games), rank=3, max_iter=3)
    ranked = recommender.recommend_als(model, users, items, 4)
    assert ranked.groupBy("user_id").count().filter("count != 4").isEmpty()


def test_hybrid_rounds_hold_only_users_and_games_with_samples(spark, monkeypatch):
    pairs = spark.createDataFrame([(1, 10, 2.0), (2, 11, 1.0)], "user_id long, game_id long, weight double")
    shares = spark.createDataFrame([(u, "a", 1.0) for u in range(1, 41)], "user_id long, category string, weight double")
    games = spark.createDataFrame([(g, ["a"]) for g in (10, 11)], "game_id long, categories array<string>")
    held, stage = [], hybrid.stage
    pairs, shares, games = (stage(rows, "given") for rows in (pairs, shares, games))

    def noted(rows, name):
        out = stage(rows, name)
        if name == "state":
            held.append(out.where(F.col("kind") == hybrid.USERS).count())
        return out

    monkeypatch.setattr(hybrid, "stage", noted)
    model = recommender.train_hybrid(pairs, shares, games, factors=2, epochs=2)
    assert held == [2, 2, 2]
    vectors = {r["user_id"]: r["vector"] for r in model.users.collect()}
    assert sorted(vectors) == list(range(1, 41))
    assert len({tuple(v) for v in vectors.values()}) == 40


def _counted(spark, rows, column):
    """The rows, with an accumulator of how often one of them was computed."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(value):
        seen.add(1)
        return value

    return rows.withColumn(column, noted.asNondeterministic()(column)), seen


def test_recommend_computes_the_playtimes_once(spark):
    playtimes = spark.createDataFrame([(u, 10 + u % 3, 5.0) for u in range(30)], "user_id long, game_id long, playtime_forever double")
    tags = spark.createDataFrame([(g, ["a", "b"]) for g in range(10, 14)], "game_id long, categories array<string>")
    games = tags.withColumns({"normalized_score": F.lit(9.5), "score": F.lit(1.0)})
    reviews = spark.createDataFrame([(1, 10, "x")], "review_id long, app_id long, app_name string")
    counted, seen = _counted(spark, playtimes, "playtime_forever")
    best = recommender.recommend(tags, counted, games, reviews, 2)
    assert best.count() == 60
    assert seen.value == 30


def test_first_rows_computes_its_rows_twice(spark):
    rows, seen = _counted(spark, spark.range(3000), "id")
    assert first_rows(rows, [F.col("id")], 2000, few=100).count() == 2000
    assert seen.value <= 6000


def test_partial_sums_are_taken_with_a_users_rows_together(spark):
    played = spark.createDataFrame([(1, 7, 2.0), (1, 8, 3.0), (None, 7, 1.0), (2, 9, 4.0)], "user_id long, game_id long, playtime_forever double")
    tags = spark.createDataFrame([(7, ["a", "b", "a"]), (8, ["a", None])], "game_id long, categories array<string>")
    profile = recommender.user_category_profile(tags, played)
    found = {tuple(r) for r in profile.collect()}
    assert found == {(1, "a", 7.0), (1, "b", 2.0), (None, "a", 2.0), (None, "b", 1.0)}
    plan = profile._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_content_scores_multiply_no_pair_by_its_tags(spark):
    pairs = spark.createDataFrame([(1, 7), (1, 7), (1, 8), (2, 7), (None, 7), (1, None), (3, 7)], "user_id long, game_id long")
    shares = spark.createDataFrame(
        [(1, "a", 0.5), (1, "a", 0.25), (1, "b", 0.25), (1, None, 1.0), (2, "c", 1.0), (3, "a", None)],
        "user_id long, category string, weight double",
    )
    games = spark.createDataFrame([(7, ["a", "b", "b"]), (8, ["c"])], "game_id long, categories array<string>")
    scores = recommender.content_scores(pairs, shares, games)
    found = {(r["user_id"], r["game_id"]): r["predicted_score"] for r in scores.collect()}
    assert found == {(1, 7): 2 * (0.75 / 4 + 0.25 * 2 / 4), (1, 8): 0.0, (2, 7): 0.0, (None, 7): 0.0, (1, None): 0.0, (3, 7): 0.0}
    joins = [x for x in scores._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert len(joins) == 2 and not any("category" in x for x in joins)
