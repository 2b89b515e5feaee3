"""Small inputs. The published totals hold for exactly these rows."""

TRANSACTIONS = [
    ("T001", "C01", "P01", "1", "2025-01-05", "PAID"),
    ("T002", "C02", "P02", "2", "2025-01-05", "PAID"),
    ("T003", "C03", "P03", "1", "2025-01-06", "PAID"),
    ("T004", "C01", "P02", "3", "2025-01-06", "PAID"),
    ("T005", "C04", "P01", "1", "2025-01-07", "FAILED"),
    ("T006", "C02", "P04", "-1", "2025-01-07", "PAID"),
    ("T007", None, "P01", "1", "2025-01-07", "PAID"),
    ("T008", "C05", "P99", "2", "2025-01-08", "PAID"),
    ("T009", "C03", "P03", "2", "not-a-date", "PAID"),
    ("T010", "C01", "P04", "1", "2025-01-08", "PAID"),
    ("T010", "C01", "P04", "1", "2025-01-08", "PAID"),
    ("T011", "C05", "P05", "4", "2025-02-01", "PAID"),
    ("T012", "C04", "P02", "2", "2025-02-01", "PAID"),
    ("T013", "C02", "P01", "1", "2025-02-02", "PAID"),
    ("T014", "C03", "P05", "0", "2025-02-02", "PAID"),
    ("T015", "C01", "P03", "2", "2025-02-03", "PAID"),
]
SALES_CUSTOMERS = [
    ("C01", "Amit", "Hyderabad", "Premium"),
    ("C02", "Sneha", "Mumbai", "Regular"),
    ("C03", "Rahul", "Delhi", "Regular"),
    ("C04", "Priya", "Bangalore", "Premium"),
    ("C05", "Karan", "Pune", "Regular"),
]
SALES_PRODUCTS = [
    ("P01", "Laptop", "Electronics", 50000.0),
    ("P02", "Mouse", "Accessories", 500.0),
    ("P03", "Phone", "Electronics", 20000.0),
    ("P04", "Headphones", "Accessories", 2000.0),
    ("P05", "Tablet", "Electronics", 15000.0),
]
CITY_REVENUE = {
    "Hyderabad": 93500.0, "Pune": 60000.0, "Mumbai": 51000.0, "Delhi": 20000.0, "Bangalore": 1000.0,
}
REJECTS = {
    "invalid_qty": 2, "unknown_product": 1, "invalid_date": 1, "missing_customer": 1,
    "payment_not_paid": 1, "valid": 9,
}

STAFF = [
    (1, "Asha", "Engineering", "F", 120000),
    (2, "Ravi", "Engineering", "M", 95000),
    (3, "Meena", "Sales", "F", 55000),
    (4, "Kiran", "Sales", "M", 48000),
    (5, "Sara", "HR", "F", 42000),
    (6, "John", "HR", "M", 60000),
    (7, "Divya", "Finance", "F", 75000),
    (8, "Arun", "Finance", "M", 38000),
    (9, "Neha", "Engineering", "F", 110000),
    (10, "Vikram", "Sales", "M", 62000),
    (11, "Pooja", "HR", "F", 45000),
    (12, "Sanjay", "Finance", "M", 80000),
]
BILLING = [
    (1, "Cardiology", 1, "OPD", 120, 240000),
    (2, "Cardiology", 1, "IPD", 30, 900000),
    (3, "Cardiology", 2, "OPD", 110, 220000),
    (4, "Cardiology", 2, "IPD", 35, 1050000),
    (5, "Orthopedics", 1, "OPD", 90, 135000),
    (6, "Orthopedics", 1, "IPD", 25, 1250000),
    (7, "Orthopedics", 2, "IPD", 28, 1400000),
    (8, "Pediatrics", 1, "OPD", 200, 200000),
    (9, "Pediatrics", 2, "OPD", 220, 220000),
    (10, "Emergency", 1, "IPD", 60, 480000),
    (11, "Emergency", 2, "IPD", 75, 600000),
    (12, "Radiology", 1, "OPD", 150, 300000),
    (13, "Radiology", 2, "OPD", 160, 320000),
    (14, "Cardiology", 3, "IPD", 40, 1200000),
    (15, "Pediatrics", 3, "OPD", 210, 210000),
]
CUSTOMERS = [
    ("C001", "Asha", "Hyderabad", 28),
    ("C002", "Ravi", "Mumbai", 35),
    ("C003", "Meena", "Delhi", 42),
    ("C004", "Kiran", "Hyderabad", 31),
    ("C005", "Sara", "Bengaluru", 26),
]
ORDERS = [
    (1, "C001", "Grocery", 250.5),
    (2, "C002", "Electronics", 1200.0),
    (3, "C001", "Grocery", 120.0),
    (4, "C003", "Fashion", 799.99),
    (5, "C004", "Electronics", 45000.0),
    (6, "C002", "Grocery", 320.0),
    (7, "C001", "Electronics", 999.0),
    (8, "C003", "Fashion", 150.0),
]
PAYROLL_STAFF = [
    (1, "Asha", "Engineering", 120000.0, 10.0),
    (2, "Ravi", "Engineering", 95000.0, 8.0),
    (3, "Meena", "Sales", 55000.0, 15.0),
    (4, "Kiran", "Sales", 48000.0, 12.0),
    (5, "Sara", "HR", 42000.0, 5.0),
    (6, "John", "HR", 60000.0, 6.0),
    (7, "Divya", "Finance", 75000.0, 10.0),
    (8, "Arun", "Finance", 38000.0, 4.0),
]
BRANCH_RISK = [
    ("B01", "Main Branch", "Hyderabad", "LOW"),
    ("B02", "Airport Branch", "Mumbai", "MEDIUM"),
    ("B03", "Border Branch", "Delhi", "HIGH"),
    ("B04", "Tech Park Branch", "Bangalore", "LOW"),
]
INVENTORY = [
    ("H01", "Taj Residency", "HOTEL", 10),
    ("H02", "Sea View Inn", "HOTEL", 8),
    ("F01", "AI-202 Hyd-Mum", "FLIGHT", 12),
    ("B01", "Volvo Hyd-Blr", "BUS", 6),
]
