LATS, LONS = (30.0, 35.0, 40.0), (-10.0, -5.0, 0.0)


def cube(spark, days, value=lambda t, i, j: t * 9 + i * 3 + j, name="sst"):
    rows = []
    for t, d in enumerate(days):
        for i, la in enumerate(LATS):
            for j, lo in enumerate(LONS):
                v = value(t, i, j)
                rows.append((d, la, lo, None if v is None else float(v)))
    return spark.createDataFrame(rows, f"time date, lat double, lon double, {name} double")
