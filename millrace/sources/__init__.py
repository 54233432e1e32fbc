"""millrace sources"""
