"""millrace streaming"""
