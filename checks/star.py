from checks import check
from tillwise.functions.exprs import round_to

# sums only: other columns are the same arithmetic in both engines
ROUND = {"fact_refund": ["amount"], "fact_ads_spend": ["spend_amount"]}
NAMES = {"dim_product": "b01", "dim_user": "b02", "dim_campaign": "b03", "dim_date": "b04", "fact_order": "b05",
         "fact_order_item": "b06", "fact_traffic": "b07", "fact_ads_spend": "b08", "fact_coupon_use": "b09",
         "fact_refund": "b10", "fact_fulfillment": "b11", "fact_inventory_movement": "b12",
         "fact_product_review": "b13", "daily_business_summary": "b14"}


def _register(view, row):
    cols = ROUND.get(view, [])
    replace = ", ".join(f"round({c}, 4) AS {c}" for c in cols)

    @check(f"{row}_{view}", f"SELECT * {f'REPLACE ({replace})' if cols else ''} FROM {view}")
    def _(s, spark):
        df = getattr(s, view)
        return df.withColumns({c: round_to(c, 4) for c in cols}) if cols else df


for _view, _row in NAMES.items():
    _register(_view, _row)
