"""Sample rows, texts and the results expected for them."""

RAW_ORDERS = [
    {"order_id": "ORD001", "user_id": "U_A", "product": "Laptop", "price": 1200.00, "quantity": 1},
    {"order_id": "ORD002", "user_id": "U_B", "product": "Mouse", "price": 25.5, "quantity": 2},
    {"order_id": "ORD003", "user_id": "U_C", "product": "", "price": 75.00, "quantity": 1},
    {"order_id": "ORD004", "user_id": "U_A", "product": "Headphones", "price": -10, "quantity": 1},
    {"order_id": "ORD005", "user_id": "U_D", "product": "Keyboard", "price": 89.99, "quantity": -3},
]
REASONS = {
    "ORD003": "String should have at least 1 character",
    "ORD004": "Input should be greater than 0",
    "ORD005": "Input should be greater than 0",
}

BRONZE = [
    ("ORD001", "U_A", "Laptop", 1200.0, 1),
    ("ORD002", "U_B", "Mouse", 25.5, 2),
    ("ORD006", "U_E", "Monitor", 340.0, 1),
    ("ORD007", "U_F", "Desk Chair", 210.0, 2),
]
UPDATES = [
    ("ORD001", "U_A", "Laptop", 1200.0, 3),
    ("ORD008", "U_G", "Webcam", 55.0, 1),
]
GOLD = [
    ("Laptop", 1, 3, 3600.0, 1200.0),
    ("Desk Chair", 1, 2, 420.0, 210.0),
    ("Monitor", 1, 1, 340.0, 340.0),
    ("Webcam", 1, 1, 55.0, 55.0),
    ("Mouse", 1, 2, 51.0, 25.5),
]
BAD = [
    ("BAD001", "U_X", "Item A", 50.0, 1),
    ("BAD001", "U_Y", "Item B", 30.0, 1),
    ("BAD003", "U_Z", None, -20.0, 2),
]

DOCUMENTS = {
    "doc1.txt": (
        "Return Policy: Customers may return unopened products within 14 days of purchase with a "
        "valid receipt. Refunds are processed within 5-7 business days to the original payment "
        "method. Opened electronics are not eligible for return unless defective. Defective items "
        "can be exchanged within 30 days.\n"
    ),
    "doc2.txt": (
        "Shipping Information: Standard shipping within Saudi Arabia takes 3-5 business days. "
        "Express shipping is available for an additional fee and delivers within 1-2 business "
        "days. Orders placed before 2 PM are processed the same day. Free shipping applies to "
        "orders over 200 SAR.\n"
    ),
    "doc3.txt": (
        "Inventory Management: Small retailers should reorder stock when inventory falls below "
        "20% of average monthly sales. Fast-moving items should be reviewed weekly, while "
        "slow-moving items can be reviewed monthly. Seasonal products require adjusted reorder "
        "points during peak demand periods like Ramadan and back-to-school season.\n"
    ),
    "doc4.txt": (
        "Payment Methods: We accept Mada, Visa, Mastercard, Apple Pay, and STC Pay. Cash on "
        "delivery is available for orders under 500 SAR within major cities. All online payments "
        "are processed through a PCI-DSS compliant payment gateway. Refunds to Mada cards may "
        "take up to 10 business days to appear.\n"
    ),
}
DOCUMENT_LENGTHS = {"doc1.txt": 296, "doc2.txt": 276, "doc3.txt": 327, "doc4.txt": 295}
CHUNK_LENGTHS = {
    "doc1.txt": [200, 135],
    "doc2.txt": [200, 114],
    "doc3.txt": [200, 165, 6],
    "doc4.txt": [200, 134],
}
KEYWORD_RANKING = {
    "Mada refund payment": [("doc4.txt_chunk1", 1.005802), ("doc4.txt_chunk0", 0.855682)],
    "express shipping fee": [("doc2.txt_chunk0", 4.493324), ("doc2.txt_chunk1", 1.081711)],
    "How do I get a refund on my Mada card?": [
        ("doc4.txt_chunk0", 2.701732),
        ("doc4.txt_chunk1", 1.481575),
        ("doc1.txt_chunk0", 0.423736),
    ],
    "How fast is express delivery?": [
        ("doc2.txt_chunk0", 2.367646),
        ("doc4.txt_chunk0", 2.29697),
        ("doc3.txt_chunk0", 1.532798),
    ],
}
