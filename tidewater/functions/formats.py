"""Text formats and names the results must reproduce exactly."""

# --- fixed values: must equal the reference's output, stated as written there ---
WINDOW_CONTENTS_FORMAT = "key:%s,窗口开始结束:[%s~%s),属于该窗口的事件时间:%s"
DASHBOARD_TOTAL_FORMAT = "时间: %s 总金额 :%s"
DASHBOARD_TOP_HEADER = "top3: \n"
DASHBOARD_TOP_FORMAT = "分类:%s 金额:%s"
MISSING_NAME = "未知"
CONNECT_STRING_PREFIX = "String:"
CONNECT_LONG_PREFIX = "Long:"
PAIR_SEPARATOR = ":::"
PAIR_SEPARATOR_SHORT = ":"
TIME_FORMAT = "HH:mm:ss"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_BUCKET_FORMAT = "yyyy-MM-dd"
UPSERT_HASH = "wcresult"
# --- end of fixed values ---

# Defaults of the text writers.
TUPLE_FORMAT = "(%s,%s)"
HOUR_BUCKET_FORMAT = "yyyy-MM-dd--HH"
