"""Lookup tables, labels and thresholds of the order business."""

# ---- Fixed values: raw order status -> standard status -------------------
ORDER_STATUS = {
    "待确认": "Pending",
    "待处理": "Pending",
    "已确认": "Confirmed",
    "配送中": "Shipping",
    "已发货": "Shipped",
    "已完成": "Delivered",
    "已取消": "Cancelled",
    "Processing": "Confirmed",
    "In Transit": "Shipping",
    "Completed": "Delivered",
    "Canceled": "Cancelled",
}

# ---- Fixed values: raw payment status -> standard status -----------------
PAYMENT_STATUS = {
    "未支付": "Unpaid",
    "已支付": "Paid",
    "部分支付": "Partial",
    "已退款": "Refunded",
    "Pending Payment": "Unpaid",
    "Payment Received": "Paid",
    "Partially Paid": "Partial",
    "Refund Processed": "Refunded",
}

# ---- Fixed values: raw order-line status -> standard status --------------
DETAIL_STATUS = {
    "待配货": "Pending",
    "配货中": "Picking",
    "已配货": "Picked",
    "待发货": "Ready",
    "已发货": "Shipped",
    "配送中": "InTransit",
    "已完成": "Delivered",
    "已取消": "Cancelled",
    "退货": "Returned",
    "换货": "Exchanged",
    "pending": "Pending",
    "picking": "Picking",
    "picked": "Picked",
    "ready": "Ready",
    "shipped": "Shipped",
    "in_transit": "InTransit",
    "delivered": "Delivered",
    "cancelled": "Cancelled",
    "returned": "Returned",
    "exchanged": "Exchanged",
}

# ---- Fixed values: raw product category -> standard category -------------
PRODUCT_CATEGORY = {
    "电子产品": "Electronics",
    "电子设备": "Electronics",
    "数码产品": "Electronics",
    "服装": "Clothing",
    "服饰": "Clothing",
    "鞋帽": "Clothing",
    "食品": "Food",
    "食物": "Food",
    "饮料": "Beverages",
    "家具": "Furniture",
    "家居": "Home",
    "装饰": "Decoration",
    "图书": "Books",
    "书籍": "Books",
    "文具": "Stationery",
    "玩具": "Toys",
    "运动": "Sports",
    "健康": "Health",
    "美容": "Beauty",
    "汽车": "Automotive",
    "工具": "Tools",
    "其他": "Others",
    "未分类": "Others",
    "electronics": "Electronics",
    "clothing": "Clothing",
    "food": "Food",
    "beverages": "Beverages",
    "furniture": "Furniture",
    "home": "Home",
    "decoration": "Decoration",
    "books": "Books",
    "stationery": "Stationery",
    "toys": "Toys",
    "sports": "Sports",
    "health": "Health",
    "beauty": "Beauty",
    "automotive": "Automotive",
    "tools": "Tools",
    "others": "Others",
}

# ---- Fixed values: labels put in place of missing values -----------------
UNKNOWN_CUSTOMER = "Unknown Customer"
DEFAULT_CUSTOMER_TYPE = "Regular"
NO_ADDRESS = "Address Not Provided"
UNKNOWN_EMPLOYEE = "Unknown Employee"
UNKNOWN_DEPARTMENT = "Unknown Department"
UNKNOWN_PRODUCT = "Unknown Product"
UNKNOWN_CATEGORY = "Unknown Category"
UNKNOWN_WAREHOUSE = "Unknown Warehouse"

# ---- Fixed values: standard statuses used by filters and checks ----------
VALID_ORDER_STATUSES = ("Pending", "Confirmed", "Shipping", "Shipped", "Delivered", "Cancelled")
OPEN_ORDER_STATUSES = ("Pending", "Confirmed", "Shipping", "Shipped")
CLOSED_ORDER_STATUSES = ("Cancelled", "Delivered")
GOOD_LEVELS = ("Good", "Excellent")
