"""The routing configuration the warehouse starts with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schemas import DIM_ROUTE, FACT_ROUTE

# source_table, source_type, sink_table, sink_columns.
FACT_ROUTES = [
    ("coupon_use", "insert", "dwd_tool_coupon_get", "id,coupon_id,user_id,get_time,coupon_status"),
    ("coupon_use", "update", "dwd_tool_coupon_use", "id,coupon_id,user_id,order_id,using_time,used_time,coupon_status"),
    ("favor_info", "insert", "dwd_interaction_favor_add", "id,user_id,sku_id,create_time"),
    ("user_info", "insert", "dwd_user_register", "id,create_time"),
]

# source_table and its kept columns. The first column is the row key, the sink table is
# the source table behind "dim_".
DIM_COLUMNS = {
    "activity_info": "id,activity_name,activity_type,activity_desc,start_time,end_time,create_time",
    "activity_rule": "id,activity_id,activity_type,condition_amount,condition_num,benefit_amount,benefit_discount,"
    "benefit_level",
    "activity_sku": "id,activity_id,sku_id,create_time",
    "base_category1": "id,name",
    "base_category2": "id,name,category1_id",
    "base_category3": "id,name,category2_id",
    "base_province": "id,name,region_id,area_code,iso_code,iso_3166_2",
    "base_region": "id,region_name",
    "base_trademark": "id,tm_name",
    "coupon_info": "id,coupon_name,coupon_type,condition_amount,condition_num,activity_id,benefit_amount,"
    "benefit_discount,create_time,range_type,limit_num,taken_count,start_time,end_time,operate_time,expire_time,"
    "range_desc",
    "coupon_range": "id,coupon_id,range_type,range_id",
    "financial_sku_cost": "id,sku_id,sku_name,busi_date,is_lastest,sku_cost,create_time",
    "sku_info": "id,spu_id,price,sku_name,sku_desc,weight,tm_id,category3_id,sku_default_img,is_sale,create_time",
    "spu_info": "id,spu_name,description,category3_id,tm_id",
    "user_info": "id,login_name,name,user_level,birthday,gender,create_time,operate_time",
    "base_dic": "dic_code,dic_name",
}


def fact_routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FACT_ROUTES, FACT_ROUTE)


def dim_routes(spark: SparkSession) -> DataFrame:
    rows = [(t, f"dim_{t}", "info", cols, cols.split(",")[0]) for t, cols in DIM_COLUMNS.items()]
    return spark.createDataFrame(rows, DIM_ROUTE)
