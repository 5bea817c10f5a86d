"""Golden values published with the original project (FIXTURES.md §3), recomputed here."""

import pandas as pd
from pyspark.sql import functions as F

from sparkgate.operators import metrics as M
from sparkgate.operators import ml_prep as ML
from sparkgate.operators import ml_split as SP
from sparkgate.operators import ml_train as MT
from sparkgate.operators import quality as Q

# Fixed values. G9/G10: class counts of the product target and the published holdout supports.
CLASS_COUNTS = {"other": 15, "finance": 14, "retail": 9, "transport": 9, "clothing": 7,
                "ecommerce": 6, "fuel": 5, "health": 5, "food": 5, "groceries": 4,
                "wholesale": 3, "travel": 2}
HOLDOUT_SUPPORT = {"clothing": 1, "ecommerce": 1, "finance": 3, "food": 1, "fuel": 1,
                   "groceries": 1, "health": 1, "other": 3, "retail": 2, "transport": 2,
                   "travel": 0, "wholesale": 1}

# Fixed values. G11: the published 12 x 12 holdout confusion matrix, non-zero cells (true, pred, n).
CONFUSION = [("clothing", "fuel", 1), ("ecommerce", "fuel", 1), ("finance", "clothing", 1),
             ("finance", "finance", 2), ("food", "transport", 1), ("fuel", "travel", 1),
             ("groceries", "finance", 1), ("health", "retail", 1), ("other", "finance", 1),
             ("other", "retail", 1), ("other", "transport", 1), ("retail", "finance", 1),
             ("retail", "transport", 1), ("transport", "finance", 1), ("transport", "fuel", 1),
             ("wholesale", "groceries", 1)]


def test_g10_holdout_supports_by_largest_remainder(spark):
    rows = [(f"{c}-{i}", c) for c, n in CLASS_COUNTS.items() for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id string, product_category string")
    sizes = {r["product_category"]: r["n_test"]
             for r in SP.holdout_sizes(df, "product_category").collect()}
    assert sizes == HOLDOUT_SUPPORT
    split = SP.stratified_holdout(df, "product_category", "customer_id")
    got = {r["product_category"]: r["n"] for r in split.where("split = 'test'")
           .groupBy("product_category").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {k: got.get(k, 0) for k in HOLDOUT_SUPPORT} == HOLDOUT_SUPPORT
    train = split.where("split = 'train'").select("customer_id")
    test = split.where("split = 'test'").select("customer_id")
    assert Q.leakage_overlap(train, test, "customer_id").count() == 0


def test_g11_metrics_from_published_confusion_matrix(spark):
    rows = [(t, p) for t, p, n in CONFUSION for _ in range(n)]
    pred = spark.createDataFrame(rows, "y_true string, y_pred string")
    labels = M.label_table(spark, sorted(CLASS_COUNTS))
    m = M.macro_metrics(pred, labels).first()
    w = M.weighted_metrics(pred, labels).first()
    assert round(m["accuracy"], 4) == 0.1176
    assert round(m["precision_macro"], 4) == 0.0278
    assert round(m["recall_macro"], 4) == 0.0556
    assert round(m["f1_macro"], 4) == 0.0370
    assert round(w["f1_weighted"], 4) == 0.0784
    dense = M.confusion_dense(pred, sorted(CLASS_COUNTS))
    assert dense.count() == 144 and dense.agg(F.sum("n")).first()[0] == 17


# Fixed values. G12: the stored voice feature table (2 people x 2 phrases x 4 variants, 17 features).
VOICE = [
    ("person1", "yes_approve", [-375.7064208984375, 33.39509582519531, 14.419486045837402, 17.470977783203125, 19.713220596313477, 9.317575454711914, -8.588242530822754, 4.1154351234436035, -9.244050025939941, 2.966827392578125, -1.3041285276412964, -0.8321992754936218, 1.417453646659851, 7332.622327302632, 3934.5414064755028, 0.03049115464091301, 0.25454872532894735]),  # noqa: E501
    ("person1", "yes_approve", [-414.5008239746094, 32.7546501159668, 18.860166549682617, 19.42900848388672, 15.398733139038086, -8.86959171295166, -5.419291019439697, -1.2469056844711304, -3.038248062133789, 5.023007392883301, -3.158034324645996, 7.680695056915283, -1.8094210624694824, 7782.930715460527, 4137.144191704737, 0.0191852655261755, 0.2859015213815789]),  # noqa: E501
    ("person1", "yes_approve", [-406.0249328613281, 32.21977996826172, 15.251008987426758, 17.870298385620117, 21.143142700195312, 9.900501251220703, -8.683821678161621, 4.255824565887451, -9.347953796386719, 3.8437888622283936, -1.1858704090118408, -0.5435639023780823, 2.344878673553467, 7391.311848958333, 3916.4838315246084, 0.0206799004226923, 0.2687644675925926]),  # noqa: E501
    ("person1", "yes_approve", [-261.1118469238281, 11.523908615112305, 13.5526762008667, 4.378844261169434, 10.522529602050781, 5.145901679992676, -5.865828990936279, -0.22044453024864197, -5.0776848793029785, 0.6540263891220093, -1.5900496244430542, 1.0421056747436523, 0.19466109573841095, 8862.329744037828, 4981.8300695318785, 0.032655175775289536, 0.4055989583333333]),  # noqa: E501
    ("person1", "confirm_transaction", [-361.81512451171875, 44.35890579223633, 3.6633777618408203, 20.157886505126953, 17.426563262939453, 1.221537470817566, -4.50245475769043, 7.458602428436279, -15.346312522888184, 2.6508090496063232, -5.191491603851318, -4.088786602020264, -2.809081554412842, 6736.383463541667, 3505.2428904367034, 0.03613467887043953, 0.21541883680555557]),  # noqa: E501
    ("person1", "confirm_transaction", [-395.87646484375, 38.88425064086914, 6.63095235824585, 22.632280349731445, 8.30163860321045, -9.375280380249023, 0.1473584771156311, -8.976090431213379, -7.752939701080322, 3.870548963546753, -9.14676570892334, 4.572707653045654, -2.7361466884613037, 7019.983723958333, 3678.1289828151353, 0.024352718144655228, 0.24789134837962962]),  # noqa: E501
    ("person1", "confirm_transaction", [-392.2002868652344, 40.97021484375, 3.822432041168213, 19.90662384033203, 16.670095443725586, 2.9758338928222656, -5.396580219268799, 7.2796831130981445, -16.164278030395508, 2.5720512866973877, -5.1996307373046875, -4.115677833557129, -2.123384475708008, 6887.558562846123, 3578.473743569725, 0.02470981702208519, 0.23393616495253164]),  # noqa: E501
    ("person1", "confirm_transaction", [-248.74224853515625, 18.80024528503418, 5.3535308837890625, 7.558476448059082, 11.34477710723877, -0.44111818075180054, -7.002379894256592, 0.1249176561832428, -9.519930839538574, -0.6133103966712952, -2.6233081817626953, -3.270153522491455, -4.154804706573486, 8401.378580729166, 4580.763848561586, 0.03828781098127365, 0.35953414351851853]),  # noqa: E501
    ("person2", "yes_approve", [-403.1396789550781, 78.11080932617188, 27.036287307739258, 17.989412307739258, 6.597663879394531, 12.455759048461914, 0.13569407165050507, 2.235018253326416, 1.703766107559204, 6.791423797607422, -0.9220163822174072, 8.50650405883789, -1.6517951488494873, 6259.229070490057, 3002.1982353891026, 0.019399946555495262, 0.1526211825284091]),  # noqa: E501
    ("person2", "yes_approve", [-427.8977966308594, 82.43338775634766, 25.165786743164062, 10.960151672363281, 6.451180934906006, 6.4284186363220215, -3.0668842792510986, 5.085428714752197, 4.662051200866699, 1.5509577989578247, 2.7464373111724854, 1.388745665550232, -0.6773154735565186, 6089.655095880682, 2902.39736302922, 0.014165137894451618, 0.14453494910037878]),  # noqa: E501
    ("person2", "yes_approve", [-431.9202575683594, 79.21359252929688, 27.79027557373047, 17.59327507019043, 6.298201084136963, 12.93804931640625, 0.07495540380477905, 2.208447217941284, 1.7540953159332275, 7.091536998748779, -1.4466583728790283, 9.10303020477295, -1.5615993738174438, 6203.854744203629, 2958.1018753457874, 0.013520151376724243, 0.15192477318548386]),  # noqa: E501
    ("person2", "yes_approve", [-274.5123291015625, 28.35004234313965, 19.69353675842285, 10.079920768737793, 5.7745890617370605, 7.128931045532227, 1.8272900581359863, 1.3612116575241089, 1.1491332054138184, 2.917285680770874, 0.46351057291030884, 2.5472776889801025, -0.9758903980255127, 8354.311856356535, 4479.801040413596, 0.021489709615707397, 0.3434207800662879]),  # noqa: E501
    ("person2", "confirm_transaction", [-371.708984375, 84.24313354492188, 18.742897033691406, 19.022836685180664, 9.151434898376465, 8.234601020812988, -1.8028061389923096, 4.921226978302002, -4.893216133117676, 3.757866144180298, 1.1581370830535889, 8.903424263000488, -1.8401788473129272, 5833.909531890369, 2845.056790076857, 0.025722865015268326, 0.14998639216188525]),  # noqa: E501
    ("person2", "confirm_transaction", [-394.1179504394531, 80.62281799316406, 13.496970176696777, 15.039436340332031, 4.472079753875732, 0.3973454236984253, -1.390568494796753, 1.0148556232452393, -0.20455524325370789, 6.321656227111816, 0.8933717012405396, -0.8708967566490173, -3.218885660171509, 5985.965716252562, 2914.7583291398164, 0.017100702971220016, 0.16760854252049182]),  # noqa: E501
    ("person2", "confirm_transaction", [-397.32177734375, 82.8070068359375, 18.599510192871094, 18.779586791992188, 9.687776565551758, 8.510004997253418, -2.0066869258880615, 4.410116672515869, -5.701072692871094, 3.9027740955352783, 1.2363337278366089, 10.151185989379883, -2.4257936477661133, 5909.96076677229, 2818.2301473597454, 0.018381496891379356, 0.153965663243007]),  # noqa: E501
    ("person2", "confirm_transaction", [-265.16290283203125, 35.27685546875, 18.088581085205078, 12.573919296264648, 8.323714256286621, 4.365752220153809, 0.679833173751831, 1.2159595489501953, -2.2737550735473633, 1.120087742805481, 1.2809478044509888, 3.419903516769409, 0.44254976511001587, 7952.017762231045, 4190.472029758353, 0.027585767209529877, 0.3150414638831967]),  # noqa: E501
]


def _voice_fold(spark, test_groups):
    rows = [(i, p, ph, f"{p}_{ph}", v) for i, (p, ph, v) in enumerate(VOICE)]
    df = spark.createDataFrame(rows, "id long, person string, phrase string, grp string, "
                                     "x array<double>")
    test = df.where(F.col("grp").isin(*test_groups))
    train = df.where(~F.col("grp").isin(*test_groups))
    mean, std = ML.scaler_arrays(ML.scaler_stats(train, "x"))      # fit on train only
    tr = ML.apply_scaler(train, "x", mean, std, "xs")
    te = ML.apply_scaler(test, "x", mean, std, "xs")
    lm = MT.label_indexer(df, "person")
    model = MT.fit_identity_model(tr, "xs", "person", lm)
    scored = MT.predict_labels(model, te.withColumn("features", MT.array_to_vector("xs")),
                               lm.labels).select(F.col("person").alias("y_true"),
                                                 F.col("predicted").alias("y_pred"), "proba")
    acc = M.macro_metrics(scored, M.label_table(spark, lm.labels)).first()["accuracy"]
    ll = M.log_loss(scored, list(lm.labels)).first()["log_loss"]
    return acc, ll


def test_g12_voice_model_reproduces_published_fold_scores(spark):
    """C = 1 maps to regParam = 1 / sum(weights) on population-std scaled inputs."""
    a1, _ = _voice_fold(spark, ["person1_yes_approve", "person2_confirm_transaction"])
    a2, ll2 = _voice_fold(spark, ["person1_confirm_transaction", "person2_yes_approve"])
    assert sorted([round(a1, 4), round(a2, 4)]) == [0.875, 1.0]
    ll = ll2 if a2 == 1.0 else _voice_fold(spark, ["person1_yes_approve",
                                                   "person2_confirm_transaction"])[1]
    assert abs(ll - 0.0300) < 0.0006


def test_g18_sample_header_triage(spark):
    rows = [("face.png", bytes(b"\x89PNG\r\n\x1a\n" + b"\x00" * 16)),
            ("corrupt.png", bytes(b"\x00\x01\x02 not a real image \xff")),
            ("ghost_face.png", None), ("notes.txt", b"hello"), ("", b"x")]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["path", "content"]),
                               "path string, content binary")
    got = {r["path"]: r["status"] for r in Q.triage_samples(df, "path", "content").collect()}
    assert got == {"face.png": "ok", "corrupt.png": "corrupted", "ghost_face.png": "missing",
                   "notes.txt": "unsupported_format", "": "invalid_path"}


# Fixed values. G4/G5: two stored customers (their transactions are not touched by the published
# winsor bounds 158.8241 / 24007.2252, so the customer table on these rows alone
# must reproduce the stored modeling rows).
TX_ROWS = [
    ("T0245", "A178", "2025-01-21 18:06:00", "19899.83", "Finance", False),
    ("T0246", "A178", "2025-02-24 15:38:00", "878.78", "Wholesale", False),
    ("T0247", "A178", "2025-02-02 09:17:00", "2071.57", "Fuel", False),
    ("T0248", "A178", "2025-02-21 04:21:00", "3018.97", "Travel", False),
    ("T0249", "A178", "2025-01-13 20:14:00", "2801.41", "Groceries", False),
    ("T0250", "A178", "2025-01-11 09:27:00", "449.18", "Travel", False),
    ("T0285", "A190", "2025-03-31 10:02:00", "21396.18", "Other", True),
    ("T0286", "A190", "2025-03-27 02:34:00", "1167.58", "Health", False),
    ("T0287", "A190", "2025-02-14 12:29:00", "8406.82", "Finance", False),
    ("T0288", "A190", "2025-02-22 11:07:00", "12614.65", "Finance", True),
    ("T0289", "A190", "2025-01-10 19:51:00", "716.57", "Fuel", False),
    ("T0290", "A190", "2025-02-06 10:25:00", "1287.42", "Wholesale", False),
]
PROFILE_ROWS = [("A178", "LinkedIn", "74", "4.9", "Positive"),
                ("A190", "Twitter", "82", "4.8", "Neutral"),
                ("A178", "LinkedIn", "53", "1.5", "Neutral"),
                ("A178", "TikTok", "68", "3.5", "Negative")]


def test_g4_g5_customer_rows(spark):
    import datetime as dt

    from sparkgate.operators import clean as CL
    from sparkgate.operators import features as FE
    tx = spark.createDataFrame(
        [(t, c, ts, a, cat, f, i) for i, (t, c, ts, a, cat, f) in enumerate(TX_ROWS)],
        "transaction_id string, customer_id string, timestamp string, amount string, "
        "category string, is_fraud boolean, src_ord long")
    prof = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(PROFILE_ROWS)],
        "customer_id string, social_media_platform string, engagement_score string, "
        "purchase_interest_score string, review_sentiment string, src_ord long")
    tf = FE.transaction_features(CL.valid_transactions(tx))
    out = {r["customer_id"]: r for r in FE.customer_table(CL.clean_profiles(prof), tf).collect()}
    a, b = out["a178"], out["a190"]
    assert round(a["total_spent"], 2) == 29119.74 and a["purchase_count"] == 6
    assert round(a["average_spent"], 2) == 4853.29 and a["fraud_rate"] == 0.0
    assert a["product_category"] == "travel" and a["days_since_last_purchase"] == 35
    assert a["last_purchase"] == dt.datetime(2025, 2, 24, 15, 38)
    assert a["engagement_score"] == 65.0 and abs(a["purchase_interest_score"] - 3.3) < 1e-12
    assert a["platform_count"] == 2 and a["main_platform"] == "linkedin"
    assert a["review_sentiment"] == "positive"          # three-way tie, first seen
    assert round(b["total_spent"], 2) == 45589.22 and abs(b["average_spent"] - 7598.2033) < 1e-4
    assert abs(b["fraud_rate"] - 1 / 3) < 1e-12 and b["product_category"] == "finance"
    assert b["days_since_last_purchase"] == 0 and b["main_platform"] == "twitter"


def test_g13_voice_novelty_profile(spark):
    """Population-std scaling on all 16 rows, class centroids, max intra-class distance."""
    from sparkgate.operators import verify as V
    rows = [(i, p, v) for i, (p, _, v) in enumerate(VOICE)]
    df = spark.createDataFrame(rows, "id long, person string, x array<double>")
    mean, std = ML.scaler_arrays(ML.scaler_stats(df, "x"))
    scaled = ML.apply_scaler(df, "x", mean, std, "xs")
    prof = {r["person"]: r["max_intra_class_distance"]
            for r in V.class_profile(scaled, "person", "xs").collect()}
    assert round(prof["person1"], 5) == 4.93836
    assert round(prof["person2"], 5) == 4.21652
