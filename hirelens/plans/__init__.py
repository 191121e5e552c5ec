"""Analytics tables (marts), the reports on them, and the jobs that refresh them."""
