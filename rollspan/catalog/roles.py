"""What each test table stands in for. The text is plain SQL that both engines read the same
way; table names are ``{placeholders}``. Every role keeps all rows of its table."""

from rollspan.functions.fixed_values import CAPABILITIES, CHARGING_CATEGORIES, DEVICE_RENAMES, MONTHLY_REVENUE, REVENUE_MEASURES

#: snapshots the registered queries run at
EVENTS_D = "20240129"
HISTORY_D = "20010730"
MONTH_D = "20010715"


def _day(ts: str) -> str:
    return f"replace(CAST(CAST({ts} AS DATE) AS STRING), '-', '')"


def _id(x: str) -> str:
    return f"'0084' || lpad(CAST({x} AS STRING), 9, '0')"


_HOUR = "lpad(CAST({k} % 24 AS STRING), 2, '0')"
_CELL = "'452-02-' || CAST({k} % 10 AS STRING) || '-' || CAST({k} % 25 AS STRING)"

_KIND = ("CASE l_linenumber WHEN 1 THEN 'MOC' WHEN 2 THEN 'MTC' WHEN 3 THEN 'ROA' WHEN 4 THEN 'CF' "
         "WHEN 5 THEN 'SMO' WHEN 6 THEN 'SMT' ELSE 'OTH' END")
_PROVINCE = "'P' || CAST(l_partkey % 25 AS STRING)"



def counters(names: list[str]) -> str:
    """A column for each month-to-date counter, different for each: some rise with the amount, some with the quantity, some have gaps."""
    def one(i: int) -> str:
        value = f"l_extendedprice * {1 + i % 7} + l_quantity * {i}" if i % 3 else f"l_quantity * {1 + i % 5} + l_linenumber"
        return f"CASE WHEN l_linenumber = {i % 9} THEN NULL ELSE {value} END"
    return ", ".join(f"CAST({one(i)} AS DOUBLE) AS {n}" for i, n in enumerate(names))


def attributes() -> str:
    """The catalogue attributes that the role ``catalogue`` lacks, different for each and with gaps. Names that begin with a digit get a letter before it."""
    has = {"t_2g", "t_3g", "t_4g", "t_5g", "image_gif87", "image_gif89a", "image_jpg", "image_png", "gsma_marketing_name"}
    flags = [c for flags in CAPABILITIES.values() for c in flags]
    out = ["CASE p_size % 3 WHEN 0 THEN 'Nokia Corporation' WHEN 1 THEN p_brand ELSE NULL END AS GSMA_manufacturer",
           "CASE p_size % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'no' WHEN 2 THEN '' ELSE NULL END AS GSMA_WLAN"]
    for i, c in enumerate(flags):
        if c.lower() not in has:
            out.append(f"CASE WHEN p_size % 19 = {i % 19} THEN NULL ELSE (p_size + {i}) % {2 + i % 3} END AS {c}")
    for i, c in enumerate(DEVICE_RENAMES):
        if c.lower() not in has:
            out.append(f"CASE WHEN p_size % 11 = {i % 11} THEN NULL ELSE p_size * {i + 1} % {i + 2} END AS {attribute(c)}")
    return ", ".join(out)


def attribute(name: str) -> str:
    return f"a{name}" if name[0].isdigit() else name


ROLES = {
    # recharge log
    "recharge": f"""
        SELECT {_id('o_custkey')} AS msisdn, o_totalprice AS reillamount,
               {_day('o_orderdate')} || {_HOUR.format(k='o_orderkey')} || '1500' AS origintimestamp,
               CASE o_orderstatus WHEN 'F' THEN 'RefillRecord' WHEN 'O' THEN 'AdjustmentRecord' ELSE 'OtherRecord' END AS module,
               CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS vouchergroup,
               CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE {_CELL.format(k='o_orderkey')} END AS cell,
               {_day('o_orderdate')} AS s3_file_date
        FROM {{orders}}""",
    # usage records
    "usage": f"""
        SELECT {_id('l_suppkey')} AS msisdn,
               {_day('l_shipdate')} || 'T' || {_HOUR.format(k='l_orderkey')} || ':10:00' AS originaltimestamp,
               {_CELL.format(k='l_suppkey')} AS originatingcellid,
               l_quantity * 10 AS duration, l_extendedprice AS volume, l_extendedprice * l_discount AS totalcost,
               CASE l_linenumber WHEN 1 THEN 'SMS' WHEN 2 THEN 'Voice' WHEN 3 THEN 'VOIP' WHEN 4 THEN 'Video Telephony'
                    WHEN 5 THEN 'MBC' WHEN 6 THEN 'Data' ELSE 'Other' END AS servicename,
               CASE WHEN l_partkey % 13 = 0 THEN '' ELSE lpad(CAST(l_partkey % 40 AS STRING), 8, '0') || '1234567' END AS imei,
               {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # usage records by charging category, one of them unknown
    "charged": f"""
        SELECT {_id('l_suppkey')} AS msisdn, l_extendedprice * l_discount AS totalcost,
               CASE {' '.join(f"WHEN l_partkey % 13 = {i} THEN '{c}'" for i, c in enumerate(CHARGING_CATEGORIES))} WHEN l_partkey % 13 = 11 THEN 'OTHER' ELSE NULL END AS chargingcategoryname,
               {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # dedicated accounts
    "account_usage": f"""
        SELECT {_id('l_suppkey')} AS msisdn,
               {_day('l_shipdate')} || 'T' || {_HOUR.format(k='l_orderkey')} || ':10:00' AS originaltimestamp,
               CASE l_linenumber WHEN 1 THEN 894 WHEN 2 THEN 28 WHEN 3 THEN 7 WHEN 4 THEN 2661 WHEN 5 THEN 8 WHEN 6 THEN 9001 ELSE 1 END AS dedicatedaccountid,
               l_extendedprice AS units, {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # data sessions
    "session": f"""
        SELECT {_id('l_suppkey')} AS msisdn, l_quantity * 20 AS duration,
               CASE WHEN l_discount = 0 THEN 0.0E0 ELSE l_extendedprice * 10 END AS data_volume_downlink,
               l_extendedprice * l_tax * 10 AS data_volume_uplink,
               CAST(CAST(CAST(l_shipdate AS DATE) AS STRING) || ' ' || {_HOUR.format(k='l_orderkey')} || ':20:00' AS TIMESTAMP) AS record_opening_time,
               CAST(l_suppkey % 10 AS STRING) AS lac, CAST(l_suppkey % 25 AS STRING) AS cell_id,
               {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # calls and messages
    "call": f"""
        SELECT {_id('l_suppkey')} AS msisdn, {_id('l_partkey % 200')} AS party_number,
               greatest(l_quantity - 5, 0.0E0) AS call_duration, {_KIND} AS call_type,
               CAST(l_suppkey % 10 AS STRING) AS lac, CAST(l_suppkey % 25 AS STRING) AS cell_id,
               CASE WHEN l_suppkey % 5 = 0 THEN '45204' ELSE '45202' END || CAST(l_suppkey AS STRING) AS imsi,
               {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # package subscriptions
    "package": f"""
        SELECT {_id('o_custkey')} AS msisdn,
               {_day('o_orderdate')} || '080000' AS time_start,
               CASE WHEN o_orderkey % 9 = 0 THEN 'null'
                    ELSE {_day('o_orderdate')} || lpad(CAST(9 + o_orderkey % 14 AS STRING), 2, '0') || '0000' END AS time_end,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'gd_1' WHEN '2-HIGH' THEN 'vp_2' WHEN '3-MEDIUM' THEN 'wifi_offload_x'
                    WHEN '5-LOW' THEN 'mytv_b' ELSE 'zz' END AS service_id,
               o_orderpriority AS service_code,
               CASE o_orderstatus WHEN 'F' THEN 'CREATE' WHEN 'O' THEN 'DELETE' ELSE 'PAUSE' END AS last_action,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'N' ELSE 'Y' END AS active,
               o_orderkey AS id, {_day('o_orderdate')} AS s3_file_date
        FROM {{orders}}""",
    # branded messages
    "brand": f"""
        SELECT {_id('o_custkey')} AS msisdn,
               CASE o_orderkey % 12 WHEN 0 THEN ' MOMO' WHEN 1 THEN 'VietBank' WHEN 2 THEN 'shopee' WHEN 3 THEN 'CGV cinema'
                    WHEN 4 THEN 'congan hn' WHEN 5 THEN 'EVN HN' WHEN 6 THEN 'RMIT uni ' WHEN 7 THEN 'benhvien a'
                    WHEN 8 THEN 'Highland coffee' WHEN 9 THEN 'xyz' WHEN 10 THEN 'Grab' ELSE 'FE CREDIT' END AS sender,
               {_day('o_orderdate')} AS s3_file_date
        FROM {{orders}}""",
    # value-added services
    "vas": f"""
        SELECT {_id('user_id')} AS msisdn,
               CASE event_type WHEN 'signup' THEN 'ENGLISH_A' WHEN 'purchase' THEN 'BONGDA1' WHEN 'view' THEN 'PHIM_HD'
                    WHEN 'click' THEN 'BACSI247' ELSE 'XYZ' END AS service_code,
               value, {_day('ts')} AS s3_file_date
        FROM {{events}}""",
    # credit advances
    "credit": f"""
        SELECT {_id('o_custkey')} AS msisdn, o_orderpriority AS pack_id, o_totalprice AS amount, o_totalprice AS credit_amount,
               {_day('o_orderdate')} AS s3_file_date
        FROM {{orders}}""",
    # transfers between subscribers
    "transfer": f"""
        SELECT {_id('l_suppkey')} AS sender, {_id('l_partkey % 200')} AS receiver, l_extendedprice AS amount,
               {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # province pings
    "ping": f"""
        SELECT {_id('l_suppkey')} AS msisdn, {_PROVINCE} AS province, {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # bill lines and payments, yyyyMM partitions
    "bill": f"""
        SELECT {_id('l_suppkey')} AS ma_tb,
               CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN '203' WHEN 3 THEN '400' WHEN 4 THEN '601' WHEN 5 THEN '705' WHEN 6 THEN '713' ELSE '999' END AS khoanmuctt_id,
               l_extendedprice AS nogoc, l_extendedprice * l_tax AS thue,
               l_extendedprice * (1 - l_discount) AS tragoc, l_extendedprice * l_discount AS trathue,
               left({_day('l_shipdate')}, 6) AS s3_file_date
        FROM {{lineitem}}""",
    # balance snapshots
    "balance": f"""
        SELECT {_id('o_custkey')} AS account_id, CASE WHEN o_orderkey % 10 = 0 THEN 0.0E0 ELSE o_totalprice / 4 END AS account_balance,
               CASE o_orderkey % 7 WHEN 0 THEN 101 WHEN 1 THEN 1370 WHEN 2 THEN 8001 WHEN 3 THEN 993 WHEN 4 THEN 601 WHEN 5 THEN 100 ELSE 55 END AS service_class_id,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS account_activated_date,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS account_activated_flag,
               {_day('o_orderdate')} AS s3_file_date
        FROM {{orders}}""",
    # month-to-date revenue counters
    "revenue": f"""
        SELECT {_id('l_suppkey')} AS accs_mthd_key, CAST(left({_day('l_shipdate')}, 6) AS INT) AS mo_key,
               l_extendedprice AS tot_rvn_amt, l_extendedprice * (1 - l_discount) AS tot_blld_amt,
               l_extendedprice * l_discount AS tot_disc_amt, l_extendedprice * l_tax AS rchrg_prmtn_amt,
               l_quantity AS voice_usg, l_quantity * 2 AS data_usg, {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # the same with every counter
    "all_revenue": f"""
        SELECT {_id('l_suppkey')} AS accs_mthd_key, CAST(left({_day('l_shipdate')}, 6) AS INT) AS mo_key,
               {counters(list(dict.fromkeys([*REVENUE_MEASURES, *(m for part in MONTHLY_REVENUE.values() for m in part)])))},
               {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # prepaid registry: one change per order
    "prepaid": f"""
        SELECT {_id('o_custkey')} AS msisdn,
               CASE o_orderkey % 5 WHEN 0 THEN 'female' WHEN 1 THEN 'Nam' WHEN 2 THEN 'NAM / M' WHEN 3 THEN '?' ELSE NULL END AS gender,
               CAST(20 + o_orderkey % 50 AS STRING) AS age,
               CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN 'unknown'
                    ELSE substring({_day('o_orderdate')}, 7, 2) || '/' || substring({_day('o_orderdate')}, 5, 2) || '/' || substring({_day('o_orderdate')}, 1, 4) || ' 10:00:00' END AS modifydate,
               {_day('o_orderdate')} AS s3_file_date
        FROM {{orders}}""",
    # directory: one change per line
    "directory": f"""
        SELECT {_id('l_partkey')} AS somay, CAST(10 * (l_orderkey % 7) AS STRING) AS nhom_tuoi, l_linenumber % 3 AS phai,
               CASE WHEN l_linenumber = 7 THEN NULL
                    ELSE substring({_day('l_shipdate')}, 7, 2) || '/' || substring({_day('l_shipdate')}, 5, 2) || '/' || substring({_day('l_shipdate')}, 1, 4) || ' 0' || CAST(l_linenumber AS STRING) || ':00:00' END AS ngay_cn,
               {_day('l_shipdate')} AS s3_file_date
        FROM {{lineitem}}""",
    # device catalogue: two snapshots of it by part key
    "catalogue": """
        SELECT lpad(CAST(p_partkey % 40 AS STRING), 8, '0') AS tac, p_name AS gsma_marketing_name,
               CAST(1990 + p_size % 12 AS STRING) AS year_released,
               CASE p_type WHEN 'STANDARD' THEN 'Smartphone' WHEN 'SMALL' THEN 'Tablet' WHEN 'LARGE' THEN 'Vehicle' WHEN 'PROMO' THEN 'Modem' ELSE p_type END AS gsma_device_type,
               CASE p_brand WHEN 'Brand#1' THEN 'Sony' WHEN 'Brand#2' THEN 'Wiko' WHEN 'Brand#3' THEN 'Lava' ELSE p_brand END AS manufacturer,
               CASE WHEN p_size % 3 = 0 THEN 'Nano, Micro' WHEN p_size % 3 = 1 THEN 'Mini' ELSE '' END AS sim_size,
               CASE WHEN p_size % 5 = 0 THEN 2048 ELSE p_size END AS internal_storage_capacity,
               CASE p_size % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN 'maybe' ELSE NULL END AS gsma_bluetooth,
               CASE p_size % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'RTOS' END AS os_name,
               CASE p_size % 5 WHEN 0 THEN 'Snapdragon 8' WHEN 1 THEN 'MT6' WHEN 2 THEN 'A12 Bionic' WHEN 3 THEN 'A9' ELSE 'Helio P' END AS chipset_name,
               CASE p_size % 4 WHEN 0 THEN 'Adreno 5' WHEN 1 THEN 'Mali-T' WHEN 2 THEN 'other' ELSE 'PowerVR' END AS gpu_name,
               CASE p_size % 8 WHEN 0 THEN 250 WHEN 1 THEN 452 WHEN 2 THEN 208 WHEN 3 THEN 310 WHEN 4 THEN 722 WHEN 5 THEN 505 WHEN 6 THEN 603 ELSE 999 END AS gsma_country_code,
               CASE p_size % 6 WHEN 0 THEN 'Not Known' WHEN 1 THEN '' WHEN 2 THEN 'LTE-M' ELSE NULL END AS gsma_lpwan,
               CASE p_size % 5 WHEN 0 THEN '2/4' WHEN 1 THEN '1024/2048' WHEN 2 THEN '8' WHEN 3 THEN '16/x' ELSE NULL END AS total_ram,
               p_size % 2 AS t_2g, p_size % 3 AS t_3g, CAST(p_size > 25 AS INT) AS t_4g, 0 AS t_5g,
               CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 2 END AS image_gif87, 1 AS image_gif89a, 0 AS image_jpg, 0 AS image_png,
               CASE WHEN p_partkey % 2 = 0 THEN '20010625' ELSE '20010501' END AS s3_file_date
        FROM {part}""",
    # the same with every attribute
    "full_catalogue": f"""
        SELECT lpad(CAST(p_partkey % 40 AS STRING), 8, '0') AS tac, p_name AS gsma_marketing_name,
               CAST(1990 + p_size % 12 AS STRING) AS year_released,
               CASE p_type WHEN 'STANDARD' THEN 'Smartphone' WHEN 'SMALL' THEN 'Tablet' WHEN 'LARGE' THEN 'Vehicle' WHEN 'PROMO' THEN 'Modem' ELSE p_type END AS gsma_device_type,
               CASE p_brand WHEN 'Brand#1' THEN 'Sony' WHEN 'Brand#2' THEN 'Wiko' WHEN 'Brand#3' THEN 'Lava' ELSE p_brand END AS manufacturer,
               CASE WHEN p_size % 3 = 0 THEN 'Nano, Micro' WHEN p_size % 3 = 1 THEN 'Mini' ELSE '' END AS sim_size,
               CASE WHEN p_size % 5 = 0 THEN 2048 ELSE p_size END AS internal_storage_capacity,
               CASE p_size % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN 'maybe' ELSE NULL END AS gsma_bluetooth,
               CASE p_size % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'RTOS' END AS os_name,
               CASE p_size % 5 WHEN 0 THEN 'Snapdragon 8' WHEN 1 THEN 'MT6' WHEN 2 THEN 'A12 Bionic' WHEN 3 THEN 'A9' ELSE 'Helio P' END AS chipset_name,
               CASE p_size % 4 WHEN 0 THEN 'Adreno 5' WHEN 1 THEN 'Mali-T' WHEN 2 THEN 'other' ELSE 'PowerVR' END AS gpu_name,
               CASE p_size % 8 WHEN 0 THEN 250 WHEN 1 THEN 452 WHEN 2 THEN 208 WHEN 3 THEN 310 WHEN 4 THEN 722 WHEN 5 THEN 505 WHEN 6 THEN 603 ELSE 999 END AS gsma_country_code,
               CASE p_size % 6 WHEN 0 THEN 'Not Known' WHEN 1 THEN '' WHEN 2 THEN 'LTE-M' ELSE NULL END AS gsma_lpwan,
               CASE p_size % 5 WHEN 0 THEN '2/4' WHEN 1 THEN '1024/2048' WHEN 2 THEN '8' WHEN 3 THEN '16/x' ELSE NULL END AS total_ram,
               p_size % 2 AS t_2g, p_size % 3 AS t_3g, CAST(p_size > 25 AS INT) AS t_4g, 0 AS t_5g,
               CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 2 END AS image_gif87, 1 AS image_gif89a, 0 AS image_jpg, 0 AS image_png,
               {attributes()},
               CASE WHEN p_partkey % 2 = 0 THEN '20010625' ELSE '20010501' END AS s3_file_date
        FROM {{part}}""",
    # cell map
    "cells": """
        SELECT CAST(s_suppkey % 10 AS STRING) AS lac, CAST(s_suppkey % 25 AS STRING) AS ci,
               'BTS' || CAST(s_nationkey AS STRING) AS bts_name,
               '200106' || lpad(CAST(15 + s_suppkey % 16 AS STRING), 2, '0') AS s3_file_date
        FROM {supplier}""",
    # labelled observations with two numeric features and a text one
    "labelled": """
        SELECT l.doc_id AS doc_id, l.quality AS y, l.toxic AS toxic, CAST(d.n_chars AS DOUBLE) AS n_chars,
               CAST(length(d.text) + 10 * (d.doc_id % 11) AS DOUBLE) AS n_text, CAST(d.doc_id % 7 AS DOUBLE) AS noise,
               CAST(CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE d.n_chars % 100 END AS DOUBLE) AS gappy,
               CAST(1 AS DOUBLE) AS constant, d.lang AS lang, d.source AS source
        FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
    # scored population: one probability per order
    "scored": f"""
        SELECT {_id('o_orderkey')} AS msisdn, (CAST(o_totalprice AS DOUBLE) / 1000000 + 0.01) AS predict_proba,
               o_orderstatus AS grp, o_orderkey AS k
        FROM {{orders}}""",
}
