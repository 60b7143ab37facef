"""Word lists, id lists, patterns and thresholds that results depend on."""

# --- fixed values: mobile package purpose, LIKE patterns on the service id ---------------
PACKAGE_PURPOSE = [
    ("family", ["gd_%", "%home%"]),
    ("office", ["vp%"]),
    ("public", ["wifi_offload%"]),
    ("relax", ["gt%", "mytv%"]),
]

# --- fixed values: package tenure in days, (label, upper bound, inclusive) ---------------
TENURE = [
    ("unknown", 0, False),
    ("one_day", 1, True),
    ("few_days", 7, True),
    ("few_weeks", 31, True),
    ("few_months", 180, True),
]
TENURE_LAST = "long_term"

# --- fixed values: last action of a package --------------------------------------------
LAST_ACTION = {"active": ["CREATE", "EXTEND"], "cancel": ["DELETE"]}

# --- fixed values: branded-sender categories, searched in this order -------------------
SENDER_CATEGORY = [
    ("finance", r"stock|bank|credit|finance|papaya.asia|cathay|baohiem|bhxh|prudential|generali|manulife|aia vietnam|sun life|shinhanlife|chubb life|phuhunglife|pay"),
    ("finance", r"^(momo|moca|vimo|hsc|tcbs|ssi|vps|vndirect|vix|vcbs|mas|vcsc|fpts|mbs|kis|tps|bvsc|shs|acbs|kbsv|bsc|vdsc|apg|ubcknn)$"),
    ("finance", r"^(lotte_fin|infina|finviet|sfin|fininteramc|finworld|gfinvn|kbfina|finbox|finpath|finhay_vn|bifin|edufin|eupfinvn|onefin|infiniqvn|affina|bifin.vn|scb|hvb|uob|lpb|shb|ocb)$"),
    ("finance", r"^(acb|vrb|ivb|msb|vib|tvb|vlb|hdb|fundiin|microfund|anbinh_fund|dsgfund|hatainvest|digiinvest|kitainvest|iceinvest|ceninvest|hudinvest|h9bc_invest|ficoinvest|vinacapital)$"),
    ("finance", r"^(mbcapital|pvcbcapital|capitaland|vwcapital|hdcapital|vtbcapital|lhcapital|voicapital|cilc-lease|vcbleasing|gmholdings|tnrholdings|pnholding|seaholdings)$"),
    ("spending", r"shopee|tiki|tiktok|amazon|bigc|nguyenkim|circle k|gs25|bachhoaxanh|tgdd|didongviet|the\s?gioi|ministop|aeon|mart|vincom|mall|service"),
    ("spending", r"cinema|cgv|htv|vtv|thvl|^Zing$|^vng$|garena|vieon|sctv|^ghn$|express|vexere|agoda|airline|vietjet|tour|hk bamboo|vinasun|taxi|^grab$|^gojek$|xanh\s?sm|bus|^uber"),
    ("spending", r"vinpearl|muongthanh|hotel|holiday|resort|spa$|vacation|gongcha|cafe|coffe|phuc long|tocotoco|lotteria|kfc|jollibee|gogi|kichikichi|bbq|manwah|highland|pizza|popeyes|tuctactea|zentea|vannamtea|zen tea|phuc tea|trungnguyen"),
    ("public_service", r"congan|hdnd|ub|ttdk|ttdk|vp bo tttt|hdnd|htx|sotuphap|thue|^evn|gas"),
    ("education_health", r"education|^thcs|^thpt|caodang|dai hoc|^hocvien|khtn|dhkt|dhnn|dhnl|tieuhoc|ngoaingu|PTNangKhieu|phenika|hutech|dhbkhn|bachkhoa|\.edu\.|^dh|rmit|dihoc|duhoc|anhngu|learn|study|teacher"),
    ("education_health", r"^bv|benhvien|hospital|dakhoa"),
]
SENDER_CATEGORIES = ["education_health", "finance", "other", "public_service", "spending"]

# --- fixed values: value-added service categories --------------------------------------
VAS_CATEGORY = [
    ("Healthcare", r"BAOHIEM|CARE|BACSY|BACSI"),
    ("Sport", r"BONGDA|ISPORT|BDAVINASPORT|GAME|ESPORT"),
    ("Study", r"ENGLISH|STUDY|HOCVUI"),
    ("Travel", r"DULICH|TRAVEL|BALODI|TRIP"),
    ("Lifestyle", r"GIAITRI|HAI|PHIM|MUSIC|CLIP|TIKTOK|FACEBOOK|ZINGMP3|SHOPEE|SHOPPING"),
]
VAS_CATEGORIES = ["Healthcare", "Sport", "Study", "Travel", "Lifestyle", "other"]

# --- fixed values: billing item groups -------------------------------------------------
FEE_GROUPS = {
    "basic_charge": ["1", "200", "201", "202", "203", "204", "205", "206"],
    "plans_promotions": ["400", "401", "600", "601", "602", "603"],
    "contract_services": ["701", "702", "703", "704", "705", "706", "707", "711", "712", "713"],
}

# --- fixed values: unit of a dedicated account id --------------------------------------
ACCOUNT_UNIT = {
    "time": [894, 82, 2678, 275, 871, 283, 2803, 2800, 630, 2663, 282, 111, 2816, 540, 294, 295, 288, 640, 252, 285, 655,
             2672, 62, 2682, 262, 2812, 2834, 272, 2681, 670, 271, 2677, 2832, 570, 8, 292, 450, 273, 2801, 920, 650, 1008,
             115, 1282, 1262, 1283, 112, 334, 2815, 331, 333, 350, 2664, 2829, 2830, 665, 930, 2824, 2802, 1062, 2817, 1272,
             2691],
    "money": [9001, 7, 2827, 162, 4, 142, 2821, 2701, 9953, 77, 2, 9998, 16, 5, 9949, 32, 3, 9999, 31, 1007, 1002, 1162,
              1004, 330, 1001, 2700, 322, 66],
    "data": [28, 1212, 965, 124, 1109, 129, 113, 5011, 400, 104, 125, 501, 103, 1409, 105, 128, 1209, 2660, 401, 102, 126,
             106, 127, 1103, 1102, 3001, 4012, 155, 950, 7071, 960, 7082, 5012, 1104, 26],
    "sms": [2661, 88, 263, 284, 2690, 255, 99, 42, 253, 122, 286, 2679, 6, 940, 1263, 1006, 2814, 1122, 1284, 2813, 2831,
            855, 755, 110, 2825, 2822, 1042, 2692],
}

# --- fixed values: subscriber service class --------------------------------------------
SERVICE_CLASS = {
    "itelecom": [101, 300, 201, 369],
    "prepaid": [1369, 1370, 1371, 1372, 1373, 1374, 1375, 1376, 1377, 1378, 1379, 1380, 1381, 1382, 1383, 1384, 1385,
                1386, 1387, 1388, 1389, 1629, 1774, 1788, 2229, 2688, 2689],
    "test": [8001, 8885, 449, 999, 8889, 8886, 9001, 8888, 8887],
    "gtel": [993, 994, 997, 592, 593, 599],
    "gmobile": [601],
    "post_paid": [100, 200],
}

# --- fixed values: balance bands, (low, high[, "open"]) --------------------------------
BALANCE_BANDS = {
    "lt_1k": (0, 1000, "open"), "lt_5k": (0, 5000, "open"), "lt_10k": (0, 10000, "open"),
    "zero": (0, 0),
    "1k_to_5k": (1000, 5000), "5k_to_10k": (5000, 10000), "10k_to_20k": (10000, 20000),
    "20k_to_50k": (20000, 50000), "50k_to_100k": (50000, 100000), "ge_100k": (100000, None),
}

# --- fixed values: usage services ------------------------------------------------------
USAGE_SERVICES = {
    "sms": ["SMS"], "voice": ["Voice"], "voip": ["VOIP"], "video": ["Video Telephony"], "data": ["MBC", "Data"],
}

# --- fixed values: call and message record kinds ---------------------------------------
CALL_KINDS = {"call_in": "MTC", "call_out": "MOC", "roam": "ROA", "cf": "CF"}
SMS_KINDS = {"sms_in": "SMT", "sms_out": "SMO"}
VOLTE_KINDS = {"call_in": "MTC", "call_out": "MOC", "cf": "CF"}

# --- fixed values: device catalogue groups ---------------------------------------------
DEVICE_TYPE = {
    "phones": ["Mobile Phone/Feature phone", "Smartphone"],
    "tablets & portables": ["Tablet", "Portable(include PDA)", "Handheld", "e-Book", "Wearable"],
    "devices telecom-related": ["Connected Computer", "Device for the Automatic Processing of Data (APD)", "Modem", "Dongle", "Module"],
    "vehicles": ["Vehicle"],
    "iot devices": ["IoT Device"],
    "network devices": ["WLAN Router"],
}
MANUFACTURER_GROUP = {
    "global brands": ["Samsung", "Apple", "Nokia", "Motorola", "Huawei", "Xiaomi", "Oppo", "Vivo", "LG", "Realme",
                      "Sony Ericsson", "Sony", "HTC", "Lenovo", "Google", "OnePlus"],
    "european brands": ["Sagem", "Ericsson", "Alcatel", "Siemens", "Philips", "Sony", "Archos", "Wiko"],
    "indian brands": ["Micromax", "Lava", "Intex", "Karbonn", "Spice", "Celkon", "iBall", "Zen", "Advan"],
}
TOP_MANUFACTURERS = [
    "Samsung Korea", "Nokia Corporation", "Apple Inc", "HUAWEI Technologies Co Ltd", "Xiaomi Communications Co Ltd",
    "Motorola Mobility LLC, a Lenovo Company", "Guangdong Oppo Mobile Telecommunications Corp Ltd",
    "Vivo Mobile Communication Co Ltd", "Realme Chongqing Mobile Telecommunications Corp Ltd", "LG Electronics Inc.",
]
CHIPSET_FAMILY = [("Snapdragon", ["Snapdragon%"]), ("Exynos", ["Exynos%"]), ("Helio", ["Helio%"]), ("MT", ["MT%"])]
GPU_FAMILY = [("Adreno", ["Adreno%"]), ("Mali", ["Mali%"]), ("PowerVR", ["PowerVR%"])]
APPLE_CHIP = r"^A[0-9].*"
APPLE_CHIP_MARKS = ["%Bionic%", "%Fusion%", "%Pro%", "%X%"]
RAM_BUCKETS = [
    (2, False, "0. <2GB"), (4, True, "1. 2GB - 4GB"), (6, True, "2. 4GB - 6GB"), (12, True, "3. 6GB - 12GB"),
]
RAM_LAST, RAM_UNKNOWN = "4. 12GB+", "-1. Unknown"
CAPABILITIES = {
    "device_has_mobile_internet": ["T_2G", "T_3G", "T_4G", "T_5G"],
    "device_support_html": ["HTML_Audio", "HTML_Canvas", "HTML_Inline_SVG", "HTML_SVG", "HTML_Video"],
    "device_support_css": ["CSS_Animations", "CSS_Columns", "CSS_Transforms", "CSS_Transitions"],
    "device_support_js": ["JS_Application_Cache", "JS_Geo_Location", "JS_Indexeddb", "JS_Local_Storage", "JS_Session_Storage",
                          "JS_Web_GL", "JS_Web_Sockets", "JS_Web_SQL_Database", "JS_Web_Workers", "JS_Device_Orientation",
                          "JS_Device_Motion", "JS_Touch_Events", "JS_Query_Selector"],
    "device_support_img": ["Image_gif87", "Image_gif89a", "Image_jpg", "Image_png"],
    "device_playable_music": ["WMV", "MIDI_Monophonic", "MIDI_Polyphonic", "AMR", "MP3", "AAC"],
}
DEVICE_RENAMES = {
    "GSMA_Marketing_Name": "device_marketing_name", "Standardised_Full_Name": "device_full_name",
    "LTE": "device_has_lte", "LTE_Advanced": "device_has_lte_advanced",
    "Chipset_Maximum_Uplink_Speed": "device_chipset_max_up_speed",
    "Chipset_Maximum_Downlink_Speed": "device_chipset_down_up_speed",
    "VoLTE": "device_has_volte", "Wi_Fi": "device_has_wifi", "VoWiFi": "device_has_vowifi", "rcs": "device_has_rcs",
    "Voice_over_Cellular": "device_has_voice_over_cell", "NB_IoT": "device_has_nb_iot", "LTE_M": "device_has_lte_m",
    "SIM_Slots": "device_sim_slots", "eSIM_Count": "device_esim_count", "Expandable_Storage": "device_expandable_storage",
    "Touch_Screen": "device_has_touch_screen", "Diagonal_Screen_Size": "device_screen_size",
    "Display_PPI": "device_display_ppi", "Device_Pixel_Ratio": "device_pixel_ratio",
    "Screen_Color_Depth": "device_screen_color_depth", "CPU_Cores": "device_cpu_cores",
    "CPU_Maximum_Frequency": "device_cpu_max_freq", "32_Bit_Architecture": "device_32_bit",
    "64_Bit_Architecture": "device_64_bit", "GPS_Hardware_Support": "device_has_gps",
    "Browser_Vendor": "device_browser_vendor", "Browser_Rendering_Engine": "device_browser_render_engine",
    "H_264_Support_In_OS": "device_support_h264", "H_265_Support_In_OS": "device_support_h265",
    "VP9_Support_In_OS": "device_support_vp9",
}

# --- fixed values: continent of a mobile country code (first list that holds it wins) --
CONTINENT = {
    "Africa": [601, 621, 608, 651, 610, 650, 617, 624, 625, 626, 630, 627, 636, 602, 629, 635, 603, 628, 634, 620, 631,
               639, 640, 616, 604, 637, 615, 609, 655, 605, 642],
    "Asia": [454, 455, 466, 428, 283, 400, 420, 470, 402, 457, 456, 460, 286, 282, 404, 510, 432, 418, 425, 440, 421, 401,
             419, 438, 502, 472, 441, 414, 431, 410, 515, 250, 511, 450, 417, 436, 520, 437, 424, 452, 427],
    "Europe": [276, 213, 283, 232, 257, 206, 293, 286, 219, 230, 238, 248, 244, 208, 282, 262, 202, 216, 274, 272, 222, 401,
               278, 247, 275, 246, 270, 259, 214, 297, 204, 295, 242, 260, 268, 226, 250, 220, 231, 240, 228, 255, 227, 407, 234],
    "North America": [342, 364, 350, 352, 302, 712, 368, 348, 370, 706, 372, 338, 334, 341, 710, 714, 340, 344, 345, 374,
                      310, 311, 312, 313, 314, 315, 316],
    "South America": [722, 736, 724, 730, 732, 740, 738, 744, 716, 748, 734],
    "Ocenia": [505, 520, 559, 535, 550, 543, 530, 544, 598, 546, 597, 537, 551],
}

# --- fixed values: senders counted as finance in the monthly sender features -----------
FINANCE_SENDERS = [
    "BACABANK", "LOTTE_FIN", "BVBank", "Sacombank", "SHB_FINANCE", "infina", "AGRIBANK-KT", "FINVIET", "HDBank",
    "EVNFinance", "BANKPLUS", "Techcombank", "Citibank VN", "Co-opBank", "LPBank", "VietinBank", "BAOVIETBank",
    "MeeyFinance", "Vietcombank", "VietABank", "AGRIBANK", "Liobank", "CBBank", "SeABank", "PGBank", "MBBANK",
    "MBBANKPLUS", "ShinhanBank", "DongA Bank", "SFIN", "PVcomBank", "SHBFinance", "PublicBank", "OCEANBANK", "NamABank",
    "Eximbank", "FinInterAMC", "FinMart", "FinWorld", "CIMB BANK", "VIETBANK", "SaiGonBank", "GPBANK", "TNEXFinance",
    "ABBANK", "KBank HCMC", "Agribank_LD", "VPBank", "TPBank", "KSFinance", "CITIBANK", "VPBank", "GFIN VN", "KB FINA",
    "FINBOX", "FINPATH", "AGRIBANK_HD", "BANKTCKCB", "FINHAY_VN", "BIFIN", "Gembank VN", "AGRIBANK_NX", "EduFin",
    "DBS Bank", "EUPFIN VN", "ONEFIN", "INFINIQVN", "Affina", "BanVietBank", "Bifin.vn", "BankSinoPac", "SCB", "HVB",
    "UOB", "LPB", "SHB", "OCB", "ACB", "VRB", "IVB", "MSB", "VIB", "TVB", "VLB", "HDB", "CTY 9PAY", "Papaya.asia",
    "ZaloPay", "myCityPay", "ECOFARMPAY", "VI VNPAY", "PAYOO", "SMARTPAY", "VNPAY-QR", "PayME", "ShopeePay",
    "VNPAY-TAXI", "VTPAY", "VNPAY", "SENPAY", "GPAY", "OMIPAY.VN", "M-PAY", "Galaxy Pay", "IPay.vn", "WEPAY", "DIGIPAY",
    "VNPT EPAY", "VITAPAY.VN", "YOPAYMENT", "VNPAY-POS", "VIETTELPAY", "PAYPAL", "EPAYJSC", "UnionPay", "PAYTRIP",
    "ONEPAY", "MOMO", "HomeCredit", "MCREDIT", "VietCredit", "VNDCREDIT", "EASY CREDIT", "FE CREDIT", "FECREDIT",
    "Fundiin", "MicroFund", "AnBinh_Fund", "DSGFund", "HATA INVEST", "DIGI INVEST", "SmartInvest", "KITA INVEST",
    "ICEinvest", "CenInvest", "HUD INVEST", "H9BC_INVEST", "FICO INVEST", "VinaCapital", "MB Capital", "PVCBCAPITAL",
    "CAPITALAND", "VW Capital", "HDCAPITAL", "VTBCAPITAL", "LHCapital", "VOI CAPITAL", "CILC-LEASE", "VCBLEASING",
    "GM Holdings", "TNRHoldings", "PNHOLDING", "Seaholdings",
]

# --- fixed values: revenue measures, source column -> feature name ----------------------
REVENUE_MEASURES = {
    "TOT_RVN_AMT": "total_revenue", "TOT_BLLD_AMT": "total_charge", "TOT_DISC_AMT": "total_discount_usage",
    "TOT_RC_RVN_AMT": "total_auto_renewal_revenue", "RCHRG_PRMTN_AMT": "recharge_amount", "ELOAD_AMT": "eload_amount",
    "RCV_AMT": "paper_amount", "ELOAD_EVT_CNT": "eload_attempt", "VOICE_USG": "call_usage", "VOICE_FREE_USG": "free_call",
    "VOICE_BLLD_USG": "paid_call", "VOICE_ONNET_IC_USG": "call_in_onnet", "VOICE_ONNET_OG_USG": "call_out_onnet",
    "VOICE_OFFNET_IC_USG": "call_in_offnet", "VOICE_OFFNET_OG_USG": "call_out_offnet", "VOICE_ISD_OG_USG": "call_international",
    "DATA_USG": "data_usage", "TOT_VOICE_RVN_AMT": "voice_revenue", "TOT_VOICE_REFUND_AMT": "voice_refund_revenue",
    "TOT_VOICE_DISC_AMT": "voice_discount_revenue", "TOT_VOICE_ONNET_IC_RVN_AMT": "call_in_onnet_revenue",
    "TOT_VOICE_ONNET_OG_RVN_AMT": "call_out_onnet_revenue", "TOT_VOICE_OFFNET_IC_RVN_AMT": "call_in_offnet_revenue",
    "TOT_VOICE_OFFNET_OG_RVN_AMT": "call_out_offnet_revenue", "TOT_VOICE_ISD_OG_RVN_AMT": "call_international_out_revenue",
    "TOT_DATA_RVN_AMT": "data_revenue", "TOT_DATA_CHRGD_AMT": "data_recharge_revenue", "TOT_SMS_RVN_AMT": "sms_revenue",
    "TOT_SMS_REFUND_AMT": "sms_refund_revenue", "TOT_SMS_ONNET_OG_RVN_AMT": "sms_out_onnet_revenue",
    "TOT_SMS_OFFNET_OG_RVN_AMT": "sms_out_offnet_revenue", "TOT_SMS_ISD_OG_RVN_AMT": "sms_international_out_revenue",
    "TOT_MMS_RVN_AMT": "mms_revenue", "TOT_MMS_NRC_RVN_AMT": "mms_non_auto_renewal_revenue",
    "TOT_VAS_DISC_AMT": "vas_discount_revenue", "TOT_OTHRS_RVN_AMT": "others_revenue",
    "TOT_OTHERS_RC_RVN_AMT": "others_auto_renewal_revenue", "SMS_FREE_USG_CNT": "sms_free_attempt",
    "SMS_BLLD_USG_CNT": "sms_paid_attemtp", "SMS_ONNET_IC_CNT": "sms_in_onnet_attempt",
    "SMS_ONNET_OG_CNT": "sms_out_onnet_attempt", "SMS_OFFNET_IC_CNT": "sms_in_offnet_attempt",
    "SMS_OFFNET_OG_CNT": "sms_out_offnet_attempt", "SMS_ISD_OG_CNT": "sms_international_out_attempt",
    "SMS_ISD_IC_CNT": "sms_international_in_attempt", "DATA_EVT_CNT": "data_attempt",
    "DATA_BYTES_RCVD": "data_upload_amount", "DATA_BYTES_SNT": "data_download_amount", "SMS_CNT": "sms_attempt",
}

# --- fixed values: month-to-date counters whose daily increments are rolled up, by part -----------
MONTHLY_REVENUE = {
    "part1": [
        "TOT_RVN_AMT", "TOT_BLLD_AMT", "TOT_REFUND_AMT", "TOT_DISC_AMT", "TOT_RC_RVN_AMT", "PSPD_PYMT_CNT", "PSPD_PYMT_HIT_CNT",
        "INV_PYMT_AMT", "INV_DISC_AMT", "RCHRG_PRMTN_AMT", "ELOAD_AMT", "RCV_AMT", "ELOAD_EVT_CNT", "RCV_HIT_CNT", "VOICE_USG",
        "VOICE_FREE_USG", "VOICE_BLLD_USG", "VOICE_ONNET_IC_USG", "VOICE_ONNET_OG_USG", "VOICE_OFFNET_IC_USG",
    ],
    "part2": [
        "VOICE_OFFNET_OG_USG", "VOICE_ISD_OG_USG", "DATA_USG", "DATA_RMNG_USG", "TOT_VOICE_RVN_AMT", "TOT_VOICE_REFUND_AMT",
        "TOT_VOICE_DISC_AMT", "TOT_VOICE_ONNET_IC_RVN_AMT", "TOT_VOICE_ONNET_OG_RVN_AMT", "TOT_VOICE_OFFNET_IC_RVN_AMT",
        "TOT_VOICE_OFFNET_OG_RVN_AMT", "TOT_VOICE_ISD_OG_RVN_AMT", "TOT_VOICE_ISD_IC_RVN_AMT", "TOT_DATA_RVN_AMT",
        "TOT_DATA_REFUND_AMT", "TOT_DATA_CHRGD_AMT", "TOT_SMS_RVN_AMT", "TOT_SMS_REFUND_AMT", "TOT_SMS_ONNET_IC_RVN_AMT",
        "TOT_SMS_ONNET_OG_RVN_AMT",
    ],
    "part3": [
        "TOT_SMS_OFFNET_IC_RVN_AMT", "TOT_SMS_OFFNET_OG_RVN_AMT", "TOT_SMS_ISD_OG_RVN_AMT", "TOT_SMS_ISD_IC_RVN_AMT",
        "TOT_MMS_RVN_AMT", "TOT_MMS_REFUND_AMT", "TOT_MMS_DISC_AMT", "TOT_MMS_RC_RVN_AMT", "TOT_MMS_NRC_RVN_AMT",
        "TOT_MMS_UC_RVN_AMT", "TOT_BUNDLE_RC_RVN_AMT", "TOT_BUNDLE_NRC_RVN_AMT", "TOT_VAS_RVN_AMT", "TOT_VAS_REFUND_AMT",
        "TOT_VAS_DISC_AMT", "TOT_DISC_AWARDED_AMT", "TOT_OTHRS_RVN_AMT", "TOT_OTHERS_RC_RVN_AMT", "TOT_OTHERS_NRC_RVN_AMT",
        "SMS_A2P_CNT",
    ],
    "part4": [
        "SMS_FREE_USG_CNT", "SMS_BLLD_USG_CNT", "SMS_ONNET_IC_CNT", "SMS_ONNET_OG_CNT", "SMS_OFFNET_IC_CNT", "SMS_OFFNET_OG_CNT",
        "SMS_ISD_OG_CNT", "SMS_ISD_IC_CNT", "DATA_EVT_CNT", "DATA_BYTES_RCVD", "DATA_BYTES_SNT", "ACCT_LATE_PYMT_EVT_CNT",
        "ACCT_LATE_PYMT_AMT", "ACCT_INTIME_PYMT_AMT", "INBOUND_CALL_CNT", "OUTBOUND_CALL_CNT", "INBOUND_SUB_CNT",
        "OUTBOUND_SUB_CNT", "INBOUND_DURATION_CNT", "OUTBOUND_DURATION_CNT", "INTRACN_DURATION_CNT", "SMS_CNT",
    ],
}

# --- fixed values: charging categories of usage records -----------------------------------------
CHARGING_CATEGORIES = ["", "DATA", "VoLTE", "SMS", "VOICE", "SERVICE_CHARGING (SCAP)", "ROAMING", "VoWIFI", "MMS", "IMS", "VIDEO"]

# --- fixed values: gender codes of the two registries ----------------------------------
GENDER = {0: ["Nữ", "female", "NỮ / F"], 1: ["Nam", "male", "NAM / M"]}

# --- fixed values: score segments, right-closed ----------------------------------------
SCORE_EDGES = [0, 579, 669, 739, 799, float("inf")]
SCORE_LABELS = ["Poor", "Fair", "Good", "Very Good", "Excellent"]

# --- fixed values: source cut-over, first date served by the newer call table -----------
CALL_TABLE_CUTOVER = "20250301"
