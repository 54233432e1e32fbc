"""millrace functions"""
