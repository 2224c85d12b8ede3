"""Column expressions; nothing here touches data or the driver."""
