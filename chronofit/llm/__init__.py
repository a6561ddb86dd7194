"""Training-data operators over document and page tables; nothing outside imports this package."""
