"""The model queries: cleaning, orders, customers, products, sellers, and the daily run."""
